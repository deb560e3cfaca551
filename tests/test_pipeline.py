"""From CSV files to marts and served tables, compared with the transforms applied directly."""

from datetime import datetime, timezone

import pytest
from conftest import values
from pyspark.sql import functions as F

from touchline.operators.loads import select_load
from touchline.operators.quality import QualityError, RowCheck
from touchline.plans import gold, marts, pipeline, serving, silver, suites
from touchline.sources.jdbc import JdbcTarget
from touchline.sources.lake import Lake
from touchline.sources.landing import land_files
from touchline.sources.storage import path_exists
from touchline.sources.tables import read_table

LINEAGE = ["ingestion_date", "source_file"]


def write_csv(frame, path):
    plain = frame.drop("_load_date", "_source_file")
    (
        plain.coalesce(2).write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@pytest.fixture(scope="module")
def inputs(raw):
    """Sources of the latest load, with statistics and cards that pass the raising suites."""
    matches = select_load(raw["matches"])
    keys = matches.select(F.col("ID").alias("partida_id"))
    cards = raw["cards"].join(keys.withColumnRenamed("partida_id", "partida_ID"), "partida_ID", "left_semi")
    return {
        "matches": matches,
        "goals": raw["goals"].join(keys, "partida_id", "left_semi"),
        "cards": cards.filter("cartao != 'azul'").dropDuplicates(),
        "match_statistics": raw["match_statistics"].join(keys, "partida_id", "left_semi"),
    }


@pytest.fixture(scope="module")
def built(spark, inputs, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    files = {source: write_csv(frame, str(root / "in" / source)) for source, frame in inputs.items()}
    lake = Lake(str(root / "lake"))
    land_files(spark, lake, {"matches": files["matches"]}, datetime(2024, 1, 1, tzinfo=timezone.utc))
    land_files(spark, lake, files, datetime(2024, 1, 2, tzinfo=timezone.utc))
    return lake, pipeline.run_all(spark, lake)


def same(left, right, drop=()):
    left, right = left.drop(*drop), right.drop(*drop)
    right = right.select(*left.columns)
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in left.dtypes]
    left, right = left.select(*rounded), right.select(*rounded)
    assert left.dtypes == right.dtypes
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_round_trip_equals_direct_transforms(spark, inputs, built):
    lake, _ = built
    matches = silver.silver_matches(inputs["matches"])
    goals = silver.silver_goals(inputs["goals"], matches)
    cards = silver.silver_cards(inputs["cards"], matches)
    statistics = silver.silver_match_statistics(inputs["match_statistics"], matches)
    same(matches, read_table(spark, lake.silver_table("matches")), LINEAGE)
    same(goals, read_table(spark, lake.silver_table("goals")), LINEAGE)
    same(cards, read_table(spark, lake.silver_table("cards")), LINEAGE)
    same(statistics, read_table(spark, lake.silver_table("match_statistics")), LINEAGE)

    facts = gold.fact_team_match_statistics(statistics)
    same(gold.fact_matches(matches), read_table(spark, lake.gold_table("fact_matches")))
    same(facts, read_table(spark, lake.gold_table("fact_team_match_statistics")))
    same(marts.team_season_summary(facts), read_table(spark, lake.mart("team_season_summary")))
    same(marts.team_home_away_summary(facts), read_table(spark, lake.mart("team_home_away_summary")))
    same(marts.top_scorers_by_season(gold.fact_goals(goals)), read_table(spark, lake.mart("top_scorers_by_season")))
    discipline = marts.team_discipline_summary(gold.fact_cards(cards), facts)
    same(discipline, read_table(spark, lake.mart("team_discipline_summary")))


def test_metrics_and_reports(built):
    _, results = built
    assert results["matches"].metrics == {"rows": 1350, "distinct_seasons": 7}
    assert results["fact_matches"].metrics == {"rows": 1350, "distinct_matches": 1350, "distinct_seasons": 7}
    assert set(results["fact_team_match_statistics"].metrics) == {"rows", "distinct_matches", "distinct_teams"}
    assert results["team_season_summary"].metrics == {"rows": 175}
    report = results["matches"].reports[1]
    assert (report.row_count, report.critical_failures, report.warning_failures) == (1350, 0, 3)
    assert max(len(check.sample_records) for check in report.checks) == pipeline.SAMPLE_LIMIT
    goals = results["goals"].reports[0]
    assert goals.critical_failures > 0


def test_lineage_names_the_load(spark, built):
    lake, _ = built
    row = read_table(spark, lake.silver_table("matches"), LINEAGE).first()
    assert str(row["ingestion_date"]) == "2024-01-02" and "load_date=2024-01-02" in row["source_file"]


def test_quarantine_holds_the_warned_rows(spark, built):
    lake, _ = built
    kept = spark.read.parquet(lake.quarantine("silver_matches"))
    found = {row[0]: row[1] for row in kept.groupBy("check_name").count().collect()}
    assert found == {"null_match_datetime": 375, "null_away_coach": 200, "null_gross_revenue": 123}


def test_marts_are_laid_out_by_season(spark, built):
    lake, _ = built
    assert path_exists(spark, lake.mart("team_season_summary") + "/season=1995")


def test_rerun_gives_identical_output(spark, built):
    lake, _ = built
    ids = sorted(values(read_table(spark, lake.silver_table("goals")), "goal_id", "minute_raw"), key=str)
    pipeline.build_silver_goals(spark, lake)
    assert sorted(values(read_table(spark, lake.silver_table("goals")), "goal_id", "minute_raw"), key=str) == ids


def test_serving_in_order_and_both_shapes(spark, built):
    lake, _ = built
    target, calls = JdbcTarget("jdbc:none"), []

    def record(frame, to, table):
        calls.append((table, frame.columns, frame.count()))

    assert serving.serve(spark, lake, target, write=record) == [*serving.FACT_TABLES, *serving.MART_TABLES]
    computed = {table: (columns, rows) for table, columns, rows in calls}
    assert len(computed["fact_matches"][0]) == 29 and computed["team_home_away_summary"][1] == 347
    calls.clear()
    serving.serve(spark, lake, target, declared=True, write=record)
    declared = {table: (columns, rows) for table, columns, rows in calls}
    wide = ["season", "team", "home_matches", "home_wins", "away_matches", "away_wins"]
    assert declared["team_home_away_summary"] == (wide, 175)
    for table, targets in serving.DECLARED.items():
        assert declared[table] == ([t.name for t in targets], computed[table][1])


def lake_with(spark, tmp_path, **frames):
    lake = Lake(str(tmp_path / "lake"))
    files = {source: write_csv(frame, str(tmp_path / "in" / source)) for source, frame in frames.items()}
    land_files(spark, lake, files)
    return lake


def test_gate_keeps_bad_matches_unpublished(spark, inputs, tmp_path):
    bad = inputs["matches"].limit(5).withColumn("vencedor", F.lit("NOBODY"))
    lake = lake_with(spark, tmp_path, matches=bad)
    with pytest.raises(QualityError, match="silver.matches gate"):
        pipeline.build_silver_matches(spark, lake)
    assert not path_exists(spark, lake.silver_table("matches"))
    kept = spark.read.parquet(lake.quarantine("silver_matches"))
    assert kept.filter("check_name in ('draw_with_winner', 'non_draw_invalid_winner')").count() == 5
    with pytest.raises(QualityError, match="silver.matches gate"):
        pipeline.build_silver_matches(spark, lake, publish_first=True)
    assert not path_exists(spark, lake.silver_table("matches"))


def test_report_after_publishing_raises_with_the_table_in_place(spark, inputs, tmp_path, monkeypatch):
    monkeypatch.setattr(suites, "silver_matches_gate", lambda: [])
    monkeypatch.setattr(suites, "silver_matches", lambda: [RowCheck("always", F.lit(True))])
    lake = lake_with(spark, tmp_path, matches=inputs["matches"].limit(5))
    with pytest.raises(QualityError):
        pipeline.build_silver_matches(spark, lake)
    assert not path_exists(spark, lake.silver_table("matches"))
    with pytest.raises(QualityError, match="silver.matches"):
        pipeline.build_silver_matches(spark, lake, publish_first=True)
    assert read_table(spark, lake.silver_table("matches")).count() == 5


def test_statistics_gate_raises_and_events_do_not(spark, raw, inputs, tmp_path):
    lake = lake_with(
        spark, tmp_path, matches=inputs["matches"], match_statistics=raw["match_statistics"], cards=raw["cards"]
    )
    pipeline.build_silver_matches(spark, lake)
    with pytest.raises(QualityError, match="null_season: 300"):
        pipeline.build_silver_match_statistics(spark, lake)
    cards = pipeline.build_silver_cards(spark, lake)
    assert cards.reports[0].critical_failures > 0 and cards.metrics["rows"] == 6000
    with pytest.raises(QualityError, match="gold.fact_cards"):
        pipeline.build_fact_cards(spark, lake)


def test_facts_refuse_an_empty_table(spark, inputs, tmp_path):
    lake = Lake(str(tmp_path))
    silver.silver_matches(inputs["matches"]).limit(0).write.parquet(lake.silver_table("matches"))
    with pytest.raises(ValueError, match="no rows in silver.matches"):
        pipeline.build_fact_matches(spark, lake)


def _counts(result):
    return [(report.suite, report.row_count, [(c.check_name, c.invalid_count) for c in report.checks]) for report in result.reports]


def test_an_incremental_run_equals_a_full_one_and_writes_only_changed_seasons(spark, inputs, tmp_path):
    lake, whole = Lake(str(tmp_path / "lake")), Lake(str(tmp_path / "whole"))
    steps = {"matches", "goals", "fact_goals", "top_scorers_by_season"}
    later = inputs["matches"].where("data rlike '1996'").select(F.col("ID").alias("partida_id"))
    first = inputs["goals"].join(later, "partida_id", "left_anti")
    for number, goals in enumerate((first, inputs["goals"])):
        files = {"matches": write_csv(inputs["matches"], str(tmp_path / f"m{number}")), "goals": write_csv(goals, str(tmp_path / f"g{number}"))}
        land_files(spark, lake, files, datetime(2024, 1, 1 + number, tzinfo=timezone.utc))
        done = pipeline.run_steps(spark, lake, steps, incremental=True)
        assert number or all(result.seasons is None or len(result.seasons) > 3 for result in done.values())
    assert {name: result.seasons for name, result in done.items()} == {
        "matches": (), "goals": (1996,), "fact_goals": (1996,), "top_scorers_by_season": (1996,)}
    land_files(spark, whole, files, datetime(2024, 1, 2, tzinfo=timezone.utc))
    full = pipeline.run_steps(spark, whole, steps)
    for name in ("matches", "goals", "fact_goals"):
        # Counts of the seasons that did not change are those of the first run. Samples name the files of their lake.
        assert _counts(done[name]) == _counts(full[name]) and done[name].metrics == full[name].metrics
    for path in (Lake.gold_table, Lake.mart):
        name = "fact_goals" if path is Lake.gold_table else "top_scorers_by_season"
        left, right = (read_table(spark, path(one, name)).drop(*LINEAGE) for one in (lake, whole))
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
