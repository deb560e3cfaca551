"""Known answers on the smallest scale, invariants of the marts, and plan shapes."""

from dataclasses import replace

import pytest
from conftest import counted, values
from pyspark.sql import functions as F

from touchline.operators.loads import select_load
from touchline.operators.numbering import measure_hot_buckets
from touchline.operators.quality import count_failures
from touchline.plans import gold, layouts, marts, serving, silver, suites


@pytest.fixture(scope="module")
def tables(spark, raw):
    matches = silver.silver_matches(select_load(raw["matches"])).cache()
    goals = silver.silver_goals(raw["goals"], matches).cache()
    cards = silver.silver_cards(raw["cards"], matches).cache()
    # Statistics of the matches in this load only, so that the raising suite passes.
    known = raw["match_statistics"].join(matches, F.col("partida_id") == F.col("match_id").cast("string"), "left_semi")
    statistics = silver.silver_match_statistics(known, matches).cache()
    return {"matches": matches, "goals": goals, "cards": cards, "match_statistics": statistics}


def test_matches_known_answers(tables):
    matches = tables["matches"]
    assert matches.columns == list(silver.MATCHES_COLUMNS) and len(matches.columns) == 26
    assert matches.count() == 1350
    assert sorted(s for (s,) in values(matches.select("season").distinct(), "season")) == list(range(1995, 2002))
    found = counted(count_failures(matches, suites.silver_matches()))
    failing = {name: count for name, count in found.items() if count}
    assert failing == {"null_match_datetime": 375, "null_away_coach": 200, "null_gross_revenue": 123}
    assert not any(counted(count_failures(matches, suites.silver_matches_gate())).values())
    assert matches.filter("is_draw").count() == 225
    assert matches.filter("home_team like 'NATION%'").count() == 1350


def test_goals_known_answers(tables):
    goals = tables["goals"]
    assert goals.columns == list(silver.GOALS_COLUMNS) and len(goals.columns) == 16
    found = counted(count_failures(goals, suites.silver_goals(goals, tables["matches"])))
    assert {name: count for name, count in found.items() if count} == {
        "null_player": 610, "null_season": 604, "invalid_team_for_match": 1381, "null_minute": 752,
        "goal_count_mismatch_vs_matches": 1106,
    }
    assert goals.count() == 6000 == goals.select("goal_id").distinct().count()
    buckets = {row[0]: row[1] for row in goals.groupBy("minute_bucket").count().collect()}
    assert buckets == {
        "00_15": 570, "16_30": 618, "31_45": 761, "46_60": 1659, "61_75": 596, "76_90": 661, "90_plus": 383, None: 752,
    }


def test_cards_known_answers(tables):
    cards = tables["cards"]
    assert cards.columns == list(silver.CARDS_COLUMNS) and len(cards.columns) == 19
    found = counted(count_failures(cards, suites.silver_cards()))
    assert cards.count() == 6000
    failing = {name: count for name, count in found.items() if count}
    assert failing == {
        "null_season": 604, "invalid_team_for_match": 604, "invalid_card_type": 147, "invalid_shirt_number": 130,
    }


def test_statistics_known_answers(tables):
    statistics = tables["match_statistics"]
    assert statistics.columns == list(silver.STATISTICS_COLUMNS) and len(statistics.columns) == 24
    assert statistics.count() == 2700
    assert not any(counted(count_failures(statistics, suites.silver_match_statistics())).values())
    assert statistics.filter("shots is null").count() == 134
    assert statistics.filter("shots = 0").count() == 160
    assert statistics.filter("shots = 0 and shot_accuracy is not null").count() == 0


def test_statistics_of_unknown_matches_fail_the_suite(spark, raw, tables):
    statistics = silver.silver_match_statistics(raw["match_statistics"], tables["matches"])
    found = counted(count_failures(statistics, suites.silver_match_statistics()))
    assert found["null_season"] == found["invalid_team_for_match"] == 300


@pytest.mark.parametrize("pieces", [2, 13, 1000])
def test_hot_matches_give_the_same_goals(raw, tables, pieces):
    hot = measure_hot_buckets(raw["goals"].selectExpr("bigint(partida_id) as match_id"), ["match_id"], rows_per_task=6)
    assert not hot.buckets.isEmpty()
    # The number of pieces follows the rows of a bucket; no number of them may change a row.
    cut = replace(hot, buckets=hot.buckets.withColumn("_pieces", F.lit(pieces).cast("bigint")))
    again = silver.silver_goals(raw["goals"], tables["matches"], cut)
    assert again.count() == 6000
    assert tables["goals"].exceptAll(again).isEmpty() and again.exceptAll(tables["goals"]).isEmpty()


def test_layouts_accept_every_header(spark):
    spellings = {
        "goals": [["partida_id", "rodada", "clube", "atleta", "minuto", "tipo gol"],
                  ["match_id", "round", "team", "player", "minute", "goal_type"]],
        "cards": [["partida_ID", "rodada", "clube", "cartão", "atleta", "num_camisa", "posição", "minuto"],
                  ["match_id", "round", "team", "card_type", "player", "shirt_number", "position", "minute"]],
        "match_statistics": [
            ["partida_id", "rodada", "clube", "chutes", "chutes a gol", "posse de bola", "passes",
             "precisao de passes", "faltas", "cartão_amarelo", "cartão_vermelho", "impedimentos", "escanteios"],
            ["match_id", "round", "team", "shots", "shots_on_target", "possession", "passes", "pass_accuracy",
             "fouls", "yellow_cards", "red_cards", "offsides", "corners"]],
    }
    layouts_by_name = {"goals": layouts.GOALS, "cards": layouts.CARDS, "match_statistics": layouts.MATCH_STATISTICS}
    for name, headers in spellings.items():
        for header in headers:
            available = [*header, "_load_date", "_source_file"]
            frame = spark.createDataFrame([tuple("1" for _ in available)], ", ".join(f"`{c}` string" for c in available))
            assert len(silver.project(frame, layouts_by_name[name]).columns) == len(available)


def test_facts(tables):
    facts = gold.fact_matches(tables["matches"])
    assert len(facts.columns) == 29 and not set(gold.LINEAGE_COLUMNS) & set(facts.columns)
    assert not any(counted(count_failures(facts, suites.fact_matches())).values())
    assert len(gold.fact_goals(tables["goals"]).columns) == 14
    assert len(gold.fact_cards(tables["cards"]).columns) == 17
    statistics = gold.fact_team_match_statistics(tables["match_statistics"])
    assert len(statistics.columns) == 28
    assert not any(counted(count_failures(statistics, suites.fact_team_match_statistics())).values())


def test_identical_cards_share_an_id_and_the_fact_suite_says_so(spark, raw, tables):
    one = raw["cards"].limit(1)
    cards = gold.fact_cards(silver.silver_cards(one.unionByName(one), tables["matches"]))
    assert counted(count_failures(cards, suites.fact_cards()))["duplicate_card_id"] == 1


def test_season_summary_invariants(tables):
    facts = gold.fact_team_match_statistics(tables["match_statistics"])
    season, sides = marts.team_season_summary(facts), marts.team_home_away_summary(facts)
    assert len(season.columns) == 27 and len(sides.columns) == 17
    assert season.count() == 175 and sides.count() == 347
    broken = season.filter("wins + draws + losses != matches or points != 3 * wins + draws")
    assert broken.isEmpty()
    totals = sides.groupBy("season", "team").agg(F.sum("matches").alias("m"), F.sum("points").alias("p"))
    joined = season.join(totals, ["season", "team"]).filter("m != matches or p != points")
    assert joined.isEmpty()
    wide = marts.home_away_wide(sides).join(season, ["season", "team"])
    assert wide.count() == 175
    assert wide.filter("home_matches + away_matches != matches or home_wins + away_wins != wins").isEmpty()


def test_scorers(tables):
    scorers = marts.top_scorers_by_season(gold.fact_goals(tables["goals"]))
    assert len(scorers.columns) == 7 and scorers.count() == 620
    assert scorers.agg(F.sum("goals")).first()[0] == 6000 - 610
    relabelled = marts.top_scorers_by_season(gold.fact_goals(tables["goals"]), "PENALTI", "x")
    assert relabelled.agg(F.sum("penalty_goals"), F.sum("own_goals_labeled")).first()[:] == (0, 0)


def test_discipline_keeps_teams_without_cards_and_drops_card_only_teams(spark, tables):
    facts = gold.fact_team_match_statistics(tables["match_statistics"])
    cards = gold.fact_cards(tables["cards"])
    full = marts.team_discipline_summary(cards, facts)
    assert len(full.columns) == 11 and full.count() == 175
    assert full.filter("cards_per_match is null").isEmpty()
    none = marts.team_discipline_summary(cards.filter("team is null"), facts)
    assert none.agg(F.sum("yellow_cards_events"), F.sum("discipline_points"), F.sum("cards_per_match")).first()[:] == (0, 0, 0)
    only_cards = marts.team_discipline_summary(cards, facts.limit(0))
    assert only_cards.isEmpty()


def test_declared_shapes(tables):
    facts = gold.fact_team_match_statistics(tables["match_statistics"])
    goals, cards = gold.fact_goals(tables["goals"]), gold.fact_cards(tables["cards"])
    frames = {
        "fact_matches": gold.fact_matches(tables["matches"]), "fact_goals": goals, "fact_cards": cards,
        "team_season_summary": marts.team_season_summary(facts),
        "top_scorers_by_season": marts.top_scorers_by_season(goals),
        "team_discipline_summary": marts.team_discipline_summary(cards, facts),
    }
    for name, frame in frames.items():
        shaped = serving.declared_shape(name, frame)
        assert shaped.dtypes == [(t.name, t.type) for t in serving.DECLARED[name]]
        assert shaped.count() == frame.count()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_matches_need_no_shuffle(raw, tables):
    plan = plan_of(silver.silver_matches(raw["matches"]))
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_goals_are_shuffled_once_for_numbering_and_join(spark, raw, tables, tmp_path):
    raw["goals"].write.parquet(str(tmp_path / "g"))
    tables["matches"].write.parquet(str(tmp_path / "m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        goals = silver.silver_goals(spark.read.parquet(str(tmp_path / "g")), spark.read.parquet(str(tmp_path / "m")))
        goals.collect()
        plan = plan_of(goals).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Goals and matches once each, and the counts of hash buckets; no trace of the route for huge groups.
    assert plan.count("Exchange hashpartitioning(match_id") == 2
    assert "SortMergeJoin" in plan and "Window" in plan and "Union" not in plan


def test_small_matches_are_broadcast(spark, raw, tables, tmp_path):
    raw["cards"].write.parquet(str(tmp_path / "c"))
    tables["matches"].write.parquet(str(tmp_path / "m"))
    plan = plan_of(silver.silver_cards(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "m"))))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_summaries_combine_before_their_shuffle(tables):
    plan = plan_of(marts.team_season_summary(gold.fact_team_match_statistics(tables["match_statistics"])))
    assert "partial_sum" in plan and plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning(season") == 1


def test_no_python_worker_in_any_table(tables):
    for frame in tables.values():
        assert "Python" not in plan_of(frame)


def test_work_without_goal_ids_distributes_no_goals(raw, tables):
    goals = silver.goals_without_ids(raw["goals"], tables["matches"])
    plan = marts.top_scorers_by_season(goals)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan and "Window" not in plan
    assert goals.columns == [column for column in silver.GOALS_COLUMNS if column != "goal_id"]
