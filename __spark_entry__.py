"""

Every query runs over whole tables. Averages and ratios are rounded to nine places, as in the SQL, because the
order of a floating-point sum is not fixed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.integrity import key_report, orphans
from touchline.operators.layout import project, rename_resolved
from touchline.operators.loads import select_load
from touchline.operators.metrics import run_metrics
from touchline.operators.quality import Check, QualityError, count_failures, samples, violations
from touchline.plans import gold, layouts, marts, pipeline, serving, silver, suites
from touchline.session import DEFAULTS, swept_session
from touchline.sources.bronze import read_bronze
from touchline.sources.check_counts import SeasonCounts
from touchline.sources.landing import land_files, with_file_digest
from touchline.sources.lake import Lake
from touchline.sources.storage import delete_path, join_path, path_exists, rename_children, staging_path
from touchline.sources.tables import read_table, write_quarantine
from verification.fixtures import RAW, raw_view
from verification.oracle import oracle_sql as _oracle_sql

try:
    import corpus_pipeline
    from touchline.llm import queries as _llm
except ImportError:
    # They, or what they need, can be left out of an installation; the other queries do without.
    _llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

PLACES = 9
OLDER_LOAD = "2024-01-01"


class Tables:
    """The pipeline's tables over one scale-factor directory, as plans that Spark prunes to what a query needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The queries run after they are returned, so the setting stays.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULTS["spark.sql.codegen.hugeMethodLimit"])
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, source: str) -> DataFrame:
        return raw_view(self.spark, self.sf_dir, source)

    @cached_property
    def _matches(self) -> DataFrame:
        return silver.silver_matches(select_load(self.raw("matches")))

    @cached_property
    def _goals(self) -> DataFrame:
        return silver.silver_goals(self.raw("goals"), self._matches)

    @cached_property
    def _unnumbered_goals(self) -> DataFrame:
        return silver.goals_without_ids(self.raw("goals"), self._matches)

    @cached_property
    def _cards(self) -> DataFrame:
        return silver.silver_cards(self.raw("cards"), self._matches)

    @cached_property
    def _statistics(self) -> DataFrame:
        return silver.silver_match_statistics(self.raw("match_statistics"), self._matches)

    def silver_matches(self) -> DataFrame:
        return self._matches

    def silver_goals(self) -> DataFrame:
        return self._goals

    def silver_cards(self) -> DataFrame:
        return self._cards

    def silver_match_statistics(self) -> DataFrame:
        return self._statistics

    def fact_matches(self) -> DataFrame:
        return gold.fact_matches(self.silver_matches())

    def fact_goals(self) -> DataFrame:
        return gold.fact_goals(self.silver_goals())

    def fact_cards(self) -> DataFrame:
        return gold.fact_cards(self.silver_cards())

    def fact_team_match_statistics(self) -> DataFrame:
        return gold.fact_team_match_statistics(self.silver_match_statistics())

    def team_season_summary(self) -> DataFrame:
        return marts.team_season_summary(self.fact_team_match_statistics())

    def team_home_away_summary(self) -> DataFrame:
        return marts.team_home_away_summary(self.fact_team_match_statistics())

    def top_scorers_by_season(self) -> DataFrame:
        return marts.top_scorers_by_season(self._unnumbered_goals)

    def team_discipline_summary(self) -> DataFrame:
        return marts.team_discipline_summary(self.fact_cards(), self.fact_team_match_statistics())

    def home_away_wide(self) -> DataFrame:
        return marts.home_away_wide(self.team_home_away_summary())


def _table(name: str) -> Query:
    return lambda spark, sf_dir: getattr(Tables(spark, sf_dir), name)()


def _rounded(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = query(spark, sf_dir)
        return frame.select(
            *[F.round(name, PLACES).alias(name) if kind == "double" else F.col(name) for name, kind in frame.dtypes]
        )

    return run


def _served(table: str) -> Query:
    return lambda spark, sf_dir: serving.declared_shape(table, _table(table)(spark, sf_dir))


def _checked(table: str, checks: Callable[[], list[Check]]) -> Query:
    return lambda spark, sf_dir: count_failures(_table(table)(spark, sf_dir), checks())


def _checked_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    goals = tables.silver_goals()
    return count_failures(goals, suites.silver_goals(goals, tables.silver_matches()))


def _silver_goals_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The goals numbered by the route for huge groups, which must not change any row."""
    tables = Tables(spark, sf_dir)
    hot = silver.measure_goals(tables.raw("goals"), rows_per_task=6)
    return silver.silver_goals(tables.raw("goals"), tables.silver_matches(), hot, rows_per_task=6)


def _resolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_resolved(Tables(spark, sf_dir).raw("cards"), layouts.CARDS)


def _load(wanted: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = select_load(Tables(spark, sf_dir).raw("matches"), wanted)
        return chosen.select(F.col("ID").alias("match_key"), F.col("_load_date").alias("load_date"))

    return run


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = Tables(spark, sf_dir).silver_matches()
    path = staging_path(spark, sf_dir, "quarantine")
    write_quarantine(violations(matches, suites.silver_matches()), path, run_date="2024-01-02")
    return spark.read.parquet(path).select("check_name", "match_id")


def _checked_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on the statistics from counts kept per season: those of a run that lacked a season, and that season's."""
    statistics = Tables(spark, sf_dir).silver_match_statistics()
    counts = SeasonCounts(spark, staging_path(spark, sf_dir, uuid.uuid4().hex, "counts"), gold.LINEAGE_COLUMNS)
    other_seasons = statistics.where(F.col("season").isNull() | (F.col("season") != int(LEFT_OUT)))
    counts(other_seasons, suites.silver_match_statistics())
    return counts(statistics, suites.silver_match_statistics()).drop("position")


SAMPLES = 5


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first violations of each check on the matches, in an order that both engines have."""
    matches = Tables(spark, sf_dir).silver_matches()
    order = F.md5(F.col("match_id").cast("string"))
    return samples(matches, suites.silver_matches(), SAMPLES, order).select("check_name", "match_id", "rank")


def _unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    keyed = {name: getattr(tables, name) for name in serving.PRIMARY_KEYS}
    keyed["team_home_away_summary"] = tables.home_away_wide
    reports = [key_report(table(), name, serving.PRIMARY_KEYS[name]) for name, table in keyed.items()]
    return reduce(DataFrame.unionByName, reports)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An orphan depends on nothing but the key, so the typed events are enough: no join to matches before this one.
    tables = Tables(spark, sf_dir)
    matches = tables.fact_matches()
    parts = [
        orphans(project(tables.raw(source), [layouts.MATCH_KEY]), matches, "match_id").select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, source in (("fact_goals", "goals"), ("fact_cards", "cards"))
    ]
    return reduce(DataFrame.unionByName, parts)


def _reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    return suites.goal_reconciliation(tables._unnumbered_goals, tables.silver_matches())


def _run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    parts = []
    for name, team in (
        ("silver_matches", "home_team"),
        ("silver_goals", "team"),
        ("silver_cards", "team"),
        ("silver_match_statistics", "team"),
    ):
        distinct = {"distinct_matches": "match_id", "distinct_seasons": "season", "distinct_teams": team}
        table = tables._unnumbered_goals if name == "silver_goals" else getattr(tables, name)()
        parts.append(run_metrics(table, distinct).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def _bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write both loads as raw CSV, then read the latest back."""
    lake = Lake(staging_path(spark, sf_dir, "bronze_roundtrip"))
    raw = Tables(spark, sf_dir).raw("matches").drop("_source_file").withColumnRenamed("_load_date", "load_date")
    (
        raw.write.mode("overwrite")
        .partitionBy("load_date")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(lake.raw_source("matches"))
    )
    return read_bronze(spark, lake, "matches").drop("_source_file")


def _landed(
    spark: SparkSession, sf_dir: str, *sources: str, chosen: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None
) -> tuple[Lake, DataFrame]:
    """Write sources as CSV files, all loads together, and land them in a new lake; the lake and its manifest."""
    work = staging_path(spark, sf_dir, uuid.uuid4().hex, "landed")
    tables, lake = Tables(spark, sf_dir), Lake(join_path(work, "lake"))
    for source in sources:
        rows = tables.raw(source)
        if chosen and source in chosen:
            rows = chosen[source](rows)
        inbox = join_path(work, "inbox", source)
        _land_rows(spark, lake, source, rows, inbox, datetime(2024, 1, 2, tzinfo=timezone.utc))
    return lake, spark.read.json(lake.manifest())


def _land_rows(spark: SparkSession, lake: Lake, source: str, rows: DataFrame, inbox: str, now: datetime) -> None:
    """Write rows of a source as CSV files and land those. Then the files go: the lake holds their lines."""
    with swept_session(spark):
        (
            rows.drop("_source_file", "_load_date")
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(inbox)
        )
        land_files(spark, lake, {source: inbox}, now)
    delete_path(spark, inbox)


def _file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land each source and sum the stored manifest per source."""
    _, manifest = _landed(spark, sf_dir, *RAW)
    names = F.array_join("columns", ",").alias("columns")
    kept = manifest.select("source_name", F.col("column_count").cast("int"), "encoding", names, "row_count")
    return kept.groupBy("source_name", "column_count", "encoding", "columns").agg(F.sum("row_count").alias("row_count"))


def _landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches as they are read back from the raw layer."""
    lake, _ = _landed(spark, sf_dir, "matches")
    return read_bronze(spark, lake, "matches").drop("_source_file")


def _landed_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches landed twice on one day, the same files with fewer rows the second time; what the raw layer then holds."""
    work = staging_path(spark, sf_dir, uuid.uuid4().hex, "again")
    matches, lake = Tables(spark, sf_dir).raw("matches"), Lake(join_path(work, "lake"))
    for number, rows in enumerate((matches, matches.where(F.col("_load_date") > OLDER_LOAD))):
        inbox = join_path(work, f"inbox-{number}")
        (
            rows.drop("_source_file", "_load_date")
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(inbox)
        )
        # The writer's names differ from run to run behind the number of the part.
        rename_children(spark, inbox, r"^(part-\d+)-.*", r"\1.csv")
        land_files(spark, lake, {"matches": inbox}, datetime(2024, 1, 2, number, tzinfo=timezone.utc))
    return read_bronze(spark, lake, "matches").drop("_source_file")


def _landed_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of all matches in order of their key: its manifest record, and the rows traced to its digest."""
    work = staging_path(spark, sf_dir, uuid.uuid4().hex, "lineage")
    names = ("ID", "rodada", "data", "mandante_Placar")
    matches = Tables(spark, sf_dir).raw("matches")
    lines = matches.select(F.concat_ws(",", *names).alias("value"), F.col("ID").cast("long").alias("k"))
    header = spark.createDataFrame([(",".join(names), -1)], "value string, k long")
    inbox = join_path(work, "inbox")
    header.unionByName(lines).orderBy("k").coalesce(1).select("value").write.text(inbox)
    rename_children(spark, inbox, r"^part-.*", "matches.csv")
    lake = Lake(join_path(work, "lake"))
    manifest = land_files(spark, lake, {"matches": inbox}, datetime(2024, 1, 2, tzinfo=timezone.utc))
    traced = with_file_digest(read_bronze(spark, lake, "matches"), manifest, "_source_file")
    counted = traced.groupBy("file_sha256").agg(F.count("*").alias("traced_rows"), F.max("_load_date").alias("traced_load_date"))
    return manifest.join(counted, "file_sha256").select(
        "source", "load_date", "file", "source_name", "original_filename", "file_size_bytes", "row_count", "column_count",
        F.array_join("columns", ",").alias("columns"), "header", "spans_lines", "file_sha256", "encoding",
        "traced_rows", "traced_load_date",
    )


def _through_layers(mart: str, source: str, fact: str) -> Query:
    """From CSV files through every layer to a mart, by the pipeline's steps, read back from the lake."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, _ = _landed(spark, sf_dir, "matches", source)
        for name in ("matches", source):
            pipeline.SILVER_STEPS[name](spark, lake)
        pipeline.FACT_STEPS[fact](spark, lake)
        pipeline.MART_STEPS[mart](spark, lake)
        return read_table(spark, lake.mart(mart))

    return _rounded(run)


def _told_apart(cards: DataFrame) -> DataFrame:
    """Cards of a known type of players with one card in the match: what the gate of the card facts lets pass."""
    seen = Window.partitionBy("partida_ID", "clube", "atleta")
    counted = cards.where("cartao <> 'azul'").withColumn("_seen", F.count(F.lit(1)).over(seen))
    return counted.where("_seen = 1").drop("_seen")


def _discipline_through_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card path from CSV files to its mart, by the pipeline's steps, each of which passes its gate."""
    lake, _ = _landed(spark, sf_dir, "matches", "cards", "match_statistics", chosen={"cards": _told_apart})
    steps = {"matches", "cards", "match_statistics", "fact_cards", "fact_team_match_statistics", "team_discipline_summary"}
    pipeline.run_steps(spark, lake, steps)
    return read_table(spark, lake.mart("team_discipline_summary"))


def _matches_through_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match facts by the pipeline's steps, over all loads."""
    lake, _ = _landed(spark, sf_dir, "matches")
    pipeline.run_steps(spark, lake, {"matches", "fact_matches"})
    return read_table(spark, lake.gold_table("fact_matches"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of the card facts over all cards: its report, whether it raised, and whether the facts were published."""
    lake, _ = _landed(spark, sf_dir, "matches", "cards")
    pipeline.run_steps(spark, lake, {"matches", "cards"})
    try:
        report, raised = pipeline.build_fact_cards(spark, lake).reports[0], False
    except QualityError as failed:
        report, raised = failed.report, True
    published = path_exists(spark, lake.gold_table("fact_cards"))
    rows = [(check.check_name, check.severity, check.invalid_count, raised, published) for check in report.checks]
    kinds = "check_name string, severity string, invalid_count bigint, raised boolean, published boolean"
    return spark.createDataFrame(rows, kinds)


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart after a full run without one season and an incremental run over a second landing that has it."""
    work = staging_path(spark, sf_dir, uuid.uuid4().hex, "rebuilt")
    lake, tables = Lake(join_path(work, "lake")), Tables(spark, sf_dir)
    steps = {"matches", "match_statistics", "fact_team_match_statistics", "team_season_summary"}
    year = F.regexp_extract("data", r"(\d{4})", 1)
    later = tables.raw("matches").where(year == LEFT_OUT).select("ID")
    for number, left_out in enumerate((later, later.limit(0))):
        for source, name in (("matches", "ID"), ("match_statistics", "partida_id")):
            rows = tables.raw(source)
            kept = rows.join(left_out.withColumnRenamed("ID", name), name, "left_anti").select(rows.columns)
            inbox = join_path(work, f"inbox-{number}", source)
            _land_rows(spark, lake, source, kept, inbox, datetime(2024, 1, 2 + number, tzinfo=timezone.utc))
        done = pipeline.run_steps(spark, lake, steps, incremental=bool(number))
    rewritten = done["team_season_summary"].seasons
    return read_table(spark, lake.mart("team_season_summary")).withColumn("rewritten", F.col("season").isin(*rewritten))


#: The season that the first load of ``pipeline_rebuilt`` lacks.
LEFT_OUT = "1995"


def entry(spark: SparkSession) -> DataFrame:
    """The season table per team, from raw text to mart."""
    return _rounded(_table("team_season_summary"))(spark, "/root/testdata/sf0.001")


def _training_data_queries() -> dict[str, Query]:
    return {} if _llm is None else _llm.queries() | {"pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    return {
        "silver_matches": _table("silver_matches"),
        "silver_goals": _table("silver_goals"),
        "silver_goals_hot": _silver_goals_in_pieces,
        "silver_cards": _table("silver_cards"),
        "silver_match_statistics": _table("silver_match_statistics"),
        "fact_matches": _table("fact_matches"),
        "fact_goals": _table("fact_goals"),
        "fact_cards": _table("fact_cards"),
        "fact_team_match_statistics": _table("fact_team_match_statistics"),
        "team_season_summary": _rounded(_table("team_season_summary")),
        "team_home_away_summary": _rounded(_table("team_home_away_summary")),
        "top_scorers_by_season": _rounded(_table("top_scorers_by_season")),
        "team_discipline_summary": _rounded(_table("team_discipline_summary")),
        "home_away_wide": _table("home_away_wide"),
        "serving_fact_matches": _served("fact_matches"),
        "serving_fact_goals": _served("fact_goals"),
        "serving_fact_cards": _served("fact_cards"),
        "serving_team_season": _served("team_season_summary"),
        "serving_scorers": _served("top_scorers_by_season"),
        "serving_discipline": _served("team_discipline_summary"),
        "dq_silver_matches_gate": _checked("silver_matches", suites.silver_matches_gate),
        "dq_silver_matches": _checked("silver_matches", suites.silver_matches),
        "dq_silver_goals": _checked_goals,
        "dq_silver_cards": _checked("silver_cards", suites.silver_cards),
        "dq_silver_match_statistics": _checked("silver_match_statistics", suites.silver_match_statistics),
        "dq_by_season": _checked_by_season,
        "dq_fact_matches": _checked("fact_matches", suites.fact_matches),
        "dq_fact_goals": _checked("fact_goals", suites.fact_goals),
        "dq_fact_cards": _checked("fact_cards", suites.fact_cards),
        "dq_fact_team_match_statistics": _checked("fact_team_match_statistics", suites.fact_team_match_statistics),
        "dq_quarantine": _quarantine,
        "dq_samples": _samples,
        "dq_unique_keys": _unique_keys,
        "dq_orphans": _orphans,
        "goal_reconciliation": _reconciliation,
        "resolved_columns": _resolved_columns,
        "latest_load": _load(None),
        "explicit_load": _load(OLDER_LOAD),
        "run_metrics": _run_metrics,
        "bronze_roundtrip": _bronze_roundtrip,
        "file_manifest": _file_manifest,
        "landed_rows": _landed_rows,
        "landed_again": _landed_again,
        "landed_lineage": _landed_lineage,
        "pipeline_team_season": _through_layers(
            "team_season_summary", "match_statistics", "fact_team_match_statistics"
        ),
        "pipeline_home_away": _through_layers(
            "team_home_away_summary", "match_statistics", "fact_team_match_statistics"
        ),
        "pipeline_rebuilt": _rounded(_rebuilt),
        "pipeline_discipline": _rounded(_discipline_through_layers),
        "pipeline_fact_matches": _matches_through_layers,
        "pipeline_gate": _gated,
        "pipeline_scorers": _through_layers("top_scorers_by_season", "goals", "fact_goals"),
    } | _training_data_queries()


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | ({} if _llm is None else _llm.oracle_sql())
