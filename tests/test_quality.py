"""Every check has rows that pass and a row that fails it, and nothing else."""

import pytest
from conftest import counted, values

from touchline.operators.quality import (
    FrameCheck,
    GroupCheck,
    QualityError,
    RowCheck,
    build_report,
    count_failures,
    failing_frame,
    repeated,
    require_no_critical,
    samples,
    violations,
)
from touchline.plans import suites

MATCH = dict(
    match_id=1, match_date="2024-05-01", season=2024, home_team="A", away_team="B", home_score=2, away_score=1,
    winner="A", winner_normalized="A", is_draw=False, total_goals=3, home_result="win", away_result="loss",
    match_datetime="2024-05-01", home_coach="c", away_coach="d", gross_revenue=1.0, match_points_home=3,
    match_points_away=0, draw_flag=0,
)
MATCH_SCHEMA = (
    "match_id bigint, match_date string, season int, home_team string, away_team string, home_score int, "
    "away_score int, winner string, winner_normalized string, is_draw boolean, total_goals int, home_result string, "
    "away_result string, match_datetime string, home_coach string, away_coach string, gross_revenue double, "
    "match_points_home int, match_points_away int, draw_flag int"
)
DRAW = dict(MATCH, match_id=2, home_score=1, away_score=1, total_goals=2, winner="-", winner_normalized=None,
            is_draw=True, home_result="draw", away_result="draw", match_points_home=1, match_points_away=1,
            draw_flag=1)

EVENT = dict(
    goal_id="g1", card_id="c1", match_id=1, team="A", player="P", season=2024, is_home_team_goal=True,
    is_home_team_card=True, minute=10, card_type="yellow", card_weight=1, shirt_number=9,
)
EVENT_SCHEMA = (
    "goal_id string, card_id string, match_id bigint, team string, player string, season int, "
    "is_home_team_goal boolean, is_home_team_card boolean, minute int, card_type string, card_weight int, "
    "shirt_number int"
)

STATS = dict(
    match_id=1, team="A", season=2024, is_home_team=True, shots=5, shots_on_target=2, possession=50.0,
    pass_accuracy=80.0, passes=1, fouls=1, yellow_cards=1, red_cards=0, offsides=0, corners=0, match_result="win",
    goals_scored=2, goals_conceded=1, opponent_team="B", match_side="home",
)
AWAY = dict(STATS, team="B", opponent_team="A", is_home_team=False, match_result="loss", goals_scored=1,
            goals_conceded=2, match_side="away")
STATS_SCHEMA = (
    "match_id bigint, team string, season int, is_home_team boolean, shots int, shots_on_target int, "
    "possession double, pass_accuracy double, passes int, fouls int, yellow_cards int, red_cards int, offsides int, "
    "corners int, match_result string, goals_scored int, goals_conceded int, opponent_team string, match_side string"
)


def table(spark, schema, rows):
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], schema)


def failures_per_row(spark, schema, rows, checks):
    """The set of row checks each row fails, in one job."""
    numbered = [dict(row, row_number=i) for i, row in enumerate(rows)]
    frame = table(spark, f"{schema}, row_number int", numbered)
    row_checks = [check for check in checks if isinstance(check, RowCheck)]
    found = [set() for _ in rows]
    for row in violations(frame, row_checks).select("row_number", "check_name").collect():
        found[row["row_number"]].add(row["check_name"])
    return found


def check_cases(spark, schema, good, cases, checks):
    """Each changed row fails exactly the checks named with its change."""
    found = failures_per_row(spark, schema, [{**good, **change} for change, _ in cases], checks)
    for (change, expected), names in zip(cases, found):
        assert names == expected, change


def failures(spark, schema, rows, checks):
    return {n: c for n, c in counted(count_failures(table(spark, schema, rows), checks)).items() if c}


GATE_CASES = [
    ({"match_date": None}, {"null_match_date"}),
    ({"season": None}, {"null_season"}),
    ({"home_team": "B", "winner": "B", "winner_normalized": "B"}, {"same_home_away_team"}),
    ({"home_score": -1, "is_draw": None}, {"negative_scores"}),
    ({"is_draw": True}, {"draw_with_winner"}),
    ({"winner": "Z"}, {"non_draw_invalid_winner"}),
    ({"winner": None}, {"non_draw_invalid_winner"}),
]
REPORT_CASES = [
    ({"match_id": None}, {"null_match_id"}),
    ({"match_date": None}, {"null_match_date"}),
    ({"season": None}, {"null_season"}),
    ({"home_team": None}, {"null_home_team"}),
    ({"away_team": None}, {"null_away_team"}),
    ({"home_team": "B", "winner_normalized": "B"}, {"same_home_away_team"}),
    ({"home_score": -1, "total_goals": 0, "home_result": "loss", "away_result": "win"}, {"negative_scores"}),
    ({"season": 2023}, {"season_mismatch"}),
    ({"total_goals": 9}, {"total_goals_mismatch"}),
    ({"is_draw": True, "winner_normalized": None}, {"is_draw_mismatch"}),
    ({"home_result": "loss"}, {"home_result_mismatch"}),
    ({"away_result": "win"}, {"away_result_mismatch"}),
    ({"winner_normalized": "Z"}, {"non_draw_invalid_winner"}),
    ({"winner_normalized": None}, {"non_draw_invalid_winner"}),
    ({"match_datetime": None}, {"null_match_datetime"}),
    ({"home_coach": None}, {"null_home_coach"}),
    ({"away_coach": None}, {"null_away_coach"}),
    ({"gross_revenue": None}, {"null_gross_revenue"}),
    ({"home_score": None}, {"null_scores", "home_result_mismatch", "away_result_mismatch"}),
]
FACT_MATCH_CASES = [
    ({"match_id": None}, {"null_match_id"}),
    ({"match_date": None}, {"null_match_date"}),
    ({"season": None}, {"null_season"}),
    ({"home_team": None}, {"null_home_team"}),
    ({"away_team": None}, {"null_away_team"}),
    ({"home_team": "B"}, {"same_home_away_team"}),
    ({"home_score": None}, {"null_scores"}),
    ({"away_score": -1, "total_goals": 1}, {"negative_scores"}),
    ({"total_goals": 9}, {"total_goals_mismatch"}),
    ({"is_draw": True, "draw_flag": 1}, {"is_draw_mismatch"}),
    ({"match_points_home": 1}, {"home_points_mismatch"}),
    ({"match_points_away": 1}, {"away_points_mismatch"}),
    ({"draw_flag": 1}, {"draw_flag_mismatch"}),
]


@pytest.mark.parametrize(
    "suite,cases",
    [(suites.silver_matches_gate, GATE_CASES), (suites.silver_matches, REPORT_CASES),
     (suites.fact_matches, FACT_MATCH_CASES)],
)
def test_match_suites(spark, suite, cases):
    assert failures(spark, MATCH_SCHEMA, [MATCH, DRAW], suite()) == {}
    check_cases(spark, MATCH_SCHEMA, MATCH, cases, suite())


def test_duplicate_and_null_match_ids(spark):
    twice = [MATCH, MATCH, MATCH, DRAW]
    nulls = [dict(MATCH, match_id=None)] * 2
    for suite in (suites.silver_matches_gate, suites.fact_matches):
        assert failures(spark, MATCH_SCHEMA, twice, suite()) == {"duplicate_match_id": 1}
        assert failures(spark, MATCH_SCHEMA, nulls, suite()) == {"duplicate_match_id": 1, "null_match_id": 2}
    assert failures(spark, MATCH_SCHEMA, twice, suites.silver_matches()) == {"duplicate_match_id": 1}
    assert failures(spark, MATCH_SCHEMA, nulls, suites.silver_matches()) == {"null_match_id": 2}


def test_draw_with_winner_in_report(spark):
    rows = [dict(DRAW, winner_normalized="A")]
    assert failures(spark, MATCH_SCHEMA, rows, suites.silver_matches()) == {"draw_with_winner": 1}


EVENT_CASES = [
    ({"match_id": None}, {"null_match_id"}),
    ({"team": None}, {"null_team"}),
    ({"player": None}, {"null_player"}),
    ({"season": None}, {"null_season"}),
    ({"minute": None}, {"null_minute"}),
    ({"minute": -1}, {"negative_minute"}),
    ({"minute": 131}, {"minute_too_high"}),
    ({"minute": 130}, set()),
]


def test_goal_suite(spark):
    matches = spark.createDataFrame([(1, 2), (7, 0)], "match_id bigint, total_goals int")
    second = dict(EVENT, goal_id="g2")

    def run(rows):
        frame = table(spark, EVENT_SCHEMA, rows)
        return {n: c for n, c in counted(count_failures(frame, suites.silver_goals(frame, matches))).items() if c}

    assert run([EVENT, second]) == {}
    cases = [*EVENT_CASES, ({"is_home_team_goal": None}, {"invalid_team_for_match"})]
    check_cases(spark, EVENT_SCHEMA, EVENT, cases, suites.silver_goals(matches, matches))
    assert run([EVENT, dict(second, match_id=None)]) == {"null_match_id": 1, "goal_count_mismatch_vs_matches": 1}
    assert run([EVENT, EVENT]) == {"duplicate_goal_id": 1}
    assert run([dict(EVENT, match_id=7), second]) == {"goal_count_mismatch_vs_matches": 2}


def test_card_suite(spark):
    second = dict(EVENT, card_id="c2", card_type="red", card_weight=2)
    assert failures(spark, EVENT_SCHEMA, [EVENT, second], suites.silver_cards()) == {}
    cases = [
        *EVENT_CASES,
        ({"is_home_team_card": None}, {"invalid_team_for_match"}),
        ({"card_type": "azul"}, {"invalid_card_type"}),
        ({"card_type": None}, set()),
        ({"card_weight": 2}, {"invalid_card_weight"}),
        ({"shirt_number": 0}, {"invalid_shirt_number"}),
        ({"shirt_number": None}, set()),
    ]
    check_cases(spark, EVENT_SCHEMA, EVENT, cases, suites.silver_cards())
    twice = failures(spark, EVENT_SCHEMA, [EVENT, EVENT, second], suites.silver_cards())
    assert twice == {"duplicate_card_id": 1}


def test_fact_event_suites(spark):
    goal_cases = [
        ({"goal_id": None}, {"null_goal_id"}), ({"match_id": None}, {"null_match_id"}),
        ({"team": None}, {"null_team"}), ({"season": None}, {"null_season"}),
        ({"minute": -1}, {"negative_minute"}),
    ]
    card_cases = [
        ({"card_id": None}, {"null_card_id"}), ({"match_id": None}, {"null_match_id"}),
        ({"team": None}, {"null_team"}), ({"season": None}, {"null_season"}),
        ({"minute": -1}, {"negative_minute"}),
        ({"card_type": "azul"}, {"invalid_card_type"}), ({"card_type": None}, set()),
    ]
    second = dict(EVENT, goal_id="g2", card_id="c2")
    for suite, cases, repeat in (
        (suites.fact_goals, goal_cases, "duplicate_goal_id"),
        (suites.fact_cards, card_cases, "duplicate_card_id"),
    ):
        assert failures(spark, EVENT_SCHEMA, [EVENT, second], suite()) == {}
        check_cases(spark, EVENT_SCHEMA, EVENT, cases, suite())
        assert failures(spark, EVENT_SCHEMA, [EVENT, EVENT, second], suite()) == {repeat: 1}


def test_statistics_suites(spark):
    silver_cases = [
        ({"team": None}, {"null_team"}),
        ({"season": None}, {"null_season"}),
        ({"is_home_team": None}, {"invalid_team_for_match"}),
        ({"shots_on_target": 6}, {"shots_on_target_greater_than_shots"}),
        ({"shots": None}, set()),
        ({"possession": 100.5}, {"invalid_possession_range"}),
        ({"possession": -1.0}, {"invalid_possession_range"}),
        ({"pass_accuracy": 101.0}, {"invalid_pass_accuracy_range"}),
        *[({name: -1}, {"negative_numeric_stats"}) for name in
          "shots_on_target passes fouls yellow_cards red_cards offsides corners".split()],
        ({"shots": -1, "shots_on_target": None}, {"negative_numeric_stats"}),
        ({"match_result": "loss"}, {"goals_scored_mismatch_vs_result"}),
        ({"match_result": None}, set()),
    ]
    fact_cases = [
        ({"team": None}, {"null_team"}),
        ({"season": None}, {"null_season"}),
        ({"match_result": None}, {"null_match_result"}),
        ({"opponent_team": "A"}, {"same_team_opponent"}),
        ({"match_side": "middle"}, {"invalid_match_side"}),
        ({"match_side": None}, set()),
        ({"goals_conceded": -1}, {"negative_goals"}),
    ]
    suites_and_cases = (
        (suites.silver_match_statistics, silver_cases, "duplicate_match_team_rows"),
        (suites.fact_team_match_statistics, fact_cases, "duplicate_match_team"),
    )
    for suite, cases, repeat in suites_and_cases:
        assert failures(spark, STATS_SCHEMA, [STATS, AWAY], suite()) == {}
        check_cases(spark, STATS_SCHEMA, STATS, cases, suite())
        assert failures(spark, STATS_SCHEMA, [STATS, STATS], suite()) == {repeat: 1}
        alone = failures(spark, STATS_SCHEMA, [STATS], suite())
        assert alone == {"rows_per_match_not_equal_2": 1}
        unkeyed = failures(spark, STATS_SCHEMA, [dict(STATS, match_id=None), AWAY], suite())
        assert unkeyed == {"null_match_id": 1, "rows_per_match_not_equal_2": 2}


def test_there_are_97_checks(spark):
    frame = table(spark, EVENT_SCHEMA, [EVENT])
    matches = spark.createDataFrame([(1, 1)], "match_id bigint, total_goals int")
    sizes = [
        len(suite)
        for suite in (
            suites.silver_matches_gate(), suites.silver_matches(), suites.silver_goals(frame, matches),
            suites.silver_cards(), suites.silver_match_statistics(), suites.fact_matches(), suites.fact_goals(),
            suites.fact_cards(), suites.fact_team_match_statistics(),
        )
    ]
    assert sizes == [8, 20, 10, 12, 11, 14, 6, 7, 9]


def mixed(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    checks = [
        RowCheck("null_k", frame.k.isNull(), "warning"),
        repeated("same_kv", "k", "v"),
        GroupCheck("k_pairs", ("k",), lambda n: n == 2, ignore_null_keys=True),
        GroupCheck("v_pairs", ("v",), lambda n: n == 2),
        FrameCheck("others", spark.range(3)),
        RowCheck("never", frame.k > 5),
    ]
    return frame, checks


def test_one_pass_counts_equal_check_by_check_counts(spark):
    frame, checks = mixed(spark)
    expected = {check.name: failing_frame(frame, check).count() for check in checks}
    assert counted(count_failures(frame, checks)) == expected
    assert expected == {"null_k": 2, "same_kv": 1, "k_pairs": 1, "v_pairs": 2, "others": 3, "never": 0}


def test_violations_hold_every_failing_row(spark):
    frame, checks = mixed(spark)
    found = violations(frame, checks).groupBy("check_name").count().collect()
    assert {row[0]: row[1] for row in found} == {
        "null_k": 2, "same_kv": 1, "k_pairs": 1, "v_pairs": 2, "others": 3,
    }


def test_report_samples_and_gate(spark):
    frame, checks = mixed(spark)
    report = build_report("mixed", frame, checks, sample_limit=1)
    assert report.row_count == 5
    assert (report.critical_failures, report.warning_failures) == (4, 1)
    assert [len(result.sample_records) for result in report.checks] == [1, 1, 1, 1, 1, 0]
    assert report.checks[2].sample_records == [{"k": 1, "count": 2}]
    with pytest.raises(QualityError, match="same_kv: 1 invalid") as raised:
        require_no_critical(report)
    assert "null_k" not in str(raised.value) and isinstance(raised.value, ValueError)
    warned = build_report("mixed", frame, [checks[0]])
    assert require_no_critical(warned) is warned


def test_samples_are_one_job_and_determined(spark):
    frame, checks = mixed(spark)
    found = [values(samples(part, checks, 2), "check_name", "rank", "k", "v", "count") for part in (frame, frame.repartition(3))]
    assert sorted(found[0], key=str) == sorted(found[1], key=str)
    assert {row[0]: row[1] for row in samples(frame, checks, 2).groupBy("check_name").count().collect()} == {
        "null_k": 2, "same_kv": 1, "k_pairs": 1, "v_pairs": 2, "others": 2,
    }
    plan = samples(frame, checks, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_reports_on_an_empty_table(spark):
    frame, checks = mixed(spark)
    report = build_report("empty", frame.limit(0), [c for c in checks if not isinstance(c, FrameCheck)])
    assert report.row_count == 0 and report.failing() == []
