"""Pipeline steps, from landed files to marts.

Each cleaned table is computed once, into an intermediate Parquet table in the shared folder. Checks, metrics
and the published table read that, with only the columns they need; a lost executor repeats no more than its
own tasks. All checks run before anything is published, unless ``publish_first`` asks for the order gate, publish,
report: then a failing gate publishes nothing, and a failing report raises with the table in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from touchline.operators.guards import require_rows
from touchline.operators.metrics import run_metrics
from touchline.operators.quality import (
    Check,
    Report,
    Suite,
    build_reports,
    positioned_counts,
    require_no_critical,
    violations,
)
from touchline.plans import gold, marts, silver, suites
from touchline.session import sized_shuffles, tuned_session
from touchline.sources.bronze import latest_load, read_bronze
from touchline.sources.check_counts import SeasonCounts
from touchline.sources.lake import Lake
from touchline.sources.storage import child_directories, delete_path, move_path, path_bytes, path_exists, staging_path
from touchline.sources.tables import changed_seasons, gathered, read_table, write_quarantine, write_seasons, write_table

SAMPLE_LIMIT = 20

Counting = Callable[[DataFrame, Sequence[Check]], DataFrame]


@dataclass(frozen=True)
class StepResult:
    """What a step wrote: its table, its metrics, and a report per suite it ran."""

    table: str
    metrics: dict[str, int]
    reports: tuple[Report, ...] = ()
    #: Seasons that an incremental run replaced or dropped; None for a run that wrote the whole table.
    seasons: tuple[int | None, ...] | None = None


def _metrics(frame: DataFrame, distinct: Mapping[str, str]) -> dict[str, int]:
    return run_metrics(frame, distinct).first().asDict()


@contextmanager
def _staged(
    spark: SparkSession, lake: Lake, name: str, transform: Callable[[silver.Arrange], DataFrame], joins: bool
) -> Iterator[tuple[str, DataFrame]]:
    """An intermediate table of this run and its path; what has not been moved by then is deleted at the end.

    ``transform`` is given what gathers rows by season. Where it joins them before, they are first stored as they are, in
    compressed columns, so that the shuffle of the join is off the disks when that of the gathering is on them.
    """
    run = uuid.uuid4().hex
    path, rows_path = staging_path(spark, lake.root, run, name), staging_path(spark, lake.root, run, f"{name}_rows")

    def arrange(rows: DataFrame) -> DataFrame:
        if not joins:
            return gathered(rows)
        write_table(rows, rows_path, ())
        return gathered(read_table(spark, rows_path, schema=rows.schema))

    try:
        frame = transform(arrange)
        write_table(frame, path)
        delete_path(spark, rows_path)
        yield path, read_table(spark, path, schema=frame.schema)
    finally:
        delete_path(spark, rows_path)
        delete_path(spark, path)


def _check(
    table: DataFrame, lake: Lake, dataset: str, planned: Sequence[Suite], run_date: str, counting: Counting
) -> list[Report]:
    """Run the suites, quarantine what they ask for, then raise on the first failing gate."""
    reports = build_reports(table, planned, counting)
    for suite, report in zip(planned, reports):
        failing = {result.check_name for result in report.failing()}
        if suite.quarantine and failing:
            failed = [check for check in suite.checks if check.name in failing]
            write_quarantine(violations(table, failed), lake.quarantine(dataset), run_date)
    for suite, report in zip(planned, reports):
        if suite.gate:
            require_no_critical(report)
    return reports


def _finish(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    path: str,
    table: DataFrame,
    planned: Sequence[Suite],
    distinct: Mapping[str, str],
    publish_first: bool = False,
    incremental: bool = False,
    staged_at: str | None = None,
) -> StepResult:
    """Check and publish, in the order asked for, then measure what was published.

    A table staged at a path is moved to its place if nothing reads it there afterwards.
    """
    today = datetime.now(timezone.utc).date().isoformat()
    before = 1 if publish_first else len(planned)
    counting: Counting = positioned_counts
    if incremental:
        counting = SeasonCounts(spark, lake.counts_of_checks(dataset), gold.LINEAGE_COLUMNS)
    reports = _check(table, lake, dataset, planned[:before], today, counting)
    seasons = _publish(spark, table, path, incremental, None if planned[before:] else staged_at)
    if planned[before:]:
        reports += _check(table, lake, dataset, planned[before:], today, counting)
    published = read_table(spark, path, schema=table.schema)
    return StepResult(path, _metrics(published, distinct), tuple(reports), seasons)


def _publish(
    spark: SparkSession, table: DataFrame, path: str, incremental: bool, movable: str | None = None
) -> tuple[int | None, ...] | None:
    """Write the table; an incremental run writes only the seasons whose rows have changed, apart from their lineage.

    A whole table that lies at ``movable`` becomes the published one as it is; it is copied only to another store.
    """
    if not incremental:
        if movable is None or not move_path(spark, movable, path):
            write_table(table, path)
        return None
    changed, gone = changed_seasons(spark, table, path, gold.LINEAGE_COLUMNS)
    write_seasons(spark, table, path, changed, gone)
    return (*changed, *gone)


_MATCHES_AND_SEASONS = {"distinct_matches": "match_id", "distinct_seasons": "season"}


def _silver_matches_table(spark: SparkSession, lake: Lake, *columns: str) -> DataFrame:
    return read_table(spark, lake.silver_table("matches"), columns)


def _build_silver(
    spark: SparkSession,
    lake: Lake,
    source: str,
    load_date: str | None,
    transform: Callable[[DataFrame, silver.Arrange], DataFrame],
    suites_of: Callable[[DataFrame], Sequence[Suite]],
    distinct: Mapping[str, str],
    publish_first: bool = False,
    incremental: bool = False,
    joins: bool = True,
) -> StepResult:
    """Compute a cleaned table once, check it, publish it.

    ``transform`` gathers rows by season where they are narrowest, before it derives the other columns.
    """
    chosen = latest_load(spark, lake, source, load_date)
    dataset = f"silver_{source}"
    with tuned_session(spark), sized_shuffles(spark, path_bytes(spark, lake.raw_load(source, chosen))):
        raw = read_bronze(spark, lake, source, chosen)
        with _staged(spark, lake, dataset, lambda arrange: transform(raw, arrange), joins) as (place, staged):
            path = lake.silver_table(source)
            planned = suites_of(staged)
            return _finish(spark, lake, dataset, path, staged, planned, distinct, publish_first, incremental, place)


def build_silver_matches(
    spark: SparkSession,
    lake: Lake,
    load_date: str | None = None,
    publish_first: bool = False,
    incremental: bool = False,
) -> StepResult:
    def planned(_: DataFrame) -> list[Suite]:
        return [
            Suite("silver.matches gate", suites.silver_matches_gate()),
            Suite("silver.matches", suites.silver_matches(), quarantine=True, sample_limit=SAMPLE_LIMIT),
        ]

    seasons = {"distinct_seasons": "season"}
    return _build_silver(
        spark, lake, "matches", load_date, silver.silver_matches, planned, seasons, publish_first, incremental, joins=False
    )


def build_silver_goals(
    spark: SparkSession, lake: Lake, load_date: str | None = None, incremental: bool = False
) -> StepResult:
    """The suite reports and never raises."""
    matches = _silver_matches_table(spark, lake, *silver.EVENT_MATCH_COLUMNS, "total_goals")

    def planned(goals: DataFrame) -> list[Suite]:
        return [Suite("silver.goals", suites.silver_goals(goals, matches), gate=False)]

    def transform(raw: DataFrame, arrange: silver.Arrange) -> DataFrame:
        return silver.silver_goals(raw, matches, arrange=arrange)

    distinct = _MATCHES_AND_SEASONS
    return _build_silver(spark, lake, "goals", load_date, transform, planned, distinct, incremental=incremental)


def build_silver_cards(
    spark: SparkSession, lake: Lake, load_date: str | None = None, incremental: bool = False
) -> StepResult:
    """The suite reports and never raises."""
    matches = _silver_matches_table(spark, lake, *silver.EVENT_MATCH_COLUMNS)

    def planned(_: DataFrame) -> list[Suite]:
        return [Suite("silver.cards", suites.silver_cards(), gate=False)]

    def transform(raw: DataFrame, arrange: silver.Arrange) -> DataFrame:
        return silver.silver_cards(raw, matches, arrange)

    distinct = _MATCHES_AND_SEASONS
    return _build_silver(spark, lake, "cards", load_date, transform, planned, distinct, incremental=incremental)


def build_silver_match_statistics(
    spark: SparkSession, lake: Lake, load_date: str | None = None, incremental: bool = False
) -> StepResult:
    matches = _silver_matches_table(spark, lake, *silver.STATISTICS_MATCH_COLUMNS)

    def planned(_: DataFrame) -> list[Suite]:
        return [Suite("silver.match_statistics", suites.silver_match_statistics())]

    def transform(raw: DataFrame, arrange: silver.Arrange) -> DataFrame:
        return silver.silver_match_statistics(raw, matches, arrange)

    return _build_silver(
        spark, lake, "match_statistics", load_date, transform, planned, _MATCHES_AND_SEASONS, incremental=incremental
    )


def _build_fact(
    spark: SparkSession,
    lake: Lake,
    name: str,
    source: str,
    transform: Callable[[DataFrame], DataFrame],
    checks: Sequence[Check],
    distinct: Mapping[str, str],
    incremental: bool,
) -> StepResult:
    """A fact is a projection of a table already laid out by season: nothing to stage, nothing to shuffle."""
    path = lake.silver_table(source)
    table = transform(require_rows(read_table(spark, path), f"silver.{source}"))
    planned = [Suite(f"gold.{name}", checks)]
    with tuned_session(spark), sized_shuffles(spark, path_bytes(spark, path)):
        return _finish(spark, lake, name, lake.gold_table(name), table, planned, distinct, incremental=incremental)


def build_fact_matches(spark: SparkSession, lake: Lake, incremental: bool = False) -> StepResult:
    checks, distinct = suites.fact_matches(), _MATCHES_AND_SEASONS
    return _build_fact(spark, lake, "fact_matches", "matches", gold.fact_matches, checks, distinct, incremental)


def build_fact_goals(spark: SparkSession, lake: Lake, incremental: bool = False) -> StepResult:
    return _build_fact(spark, lake, "fact_goals", "goals", gold.fact_goals, suites.fact_goals(), {}, incremental)


def build_fact_cards(spark: SparkSession, lake: Lake, incremental: bool = False) -> StepResult:
    return _build_fact(spark, lake, "fact_cards", "cards", gold.fact_cards, suites.fact_cards(), {}, incremental)


def build_fact_team_match_statistics(spark: SparkSession, lake: Lake, incremental: bool = False) -> StepResult:
    return _build_fact(
        spark,
        lake,
        "fact_team_match_statistics",
        "match_statistics",
        gold.fact_team_match_statistics,
        suites.fact_team_match_statistics(),
        {"distinct_matches": "match_id", "distinct_teams": "team"},
        incremental,
    )


def _build_mart(
    spark: SparkSession,
    lake: Lake,
    name: str,
    transform: Callable[..., DataFrame],
    *sources: str,
    seasons: Sequence[int | None] | None = None,
) -> StepResult:
    """A mart groups by season, so that a run for some ``seasons`` reads and writes only their partitions."""
    paths = [lake.gold_table(source) for source in sources]
    table = transform(*[read_table(spark, path, seasons=seasons) for path in paths])
    path = lake.mart(name)
    with tuned_session(spark), sized_shuffles(spark, path_bytes(spark, *paths)):
        if seasons is None:
            write_table(table, path)
        else:
            gone = _seasons_at(spark, path) - {season for source in paths for season in _seasons_at(spark, source)}
            write_seasons(spark, table, path, seasons, list(gone))
    published = None if seasons is None else tuple(seasons)
    return StepResult(path, _metrics(read_table(spark, path, schema=table.schema), {}), seasons=published)


def _seasons_at(spark: SparkSession, path: str) -> set[int | None]:
    """Seasons of a table, by the names of its folders."""
    names = [name.partition("=")[2] for name in child_directories(spark, path) if name.startswith("season=")]
    return {int(name) if name.lstrip("-").isdigit() else None for name in names}


Seasons = Sequence[int | None] | None


def build_team_season_summary(spark: SparkSession, lake: Lake, seasons: Seasons = None) -> StepResult:
    name, source = "team_season_summary", "fact_team_match_statistics"
    return _build_mart(spark, lake, name, marts.team_season_summary, source, seasons=seasons)


def build_team_home_away_summary(spark: SparkSession, lake: Lake, seasons: Seasons = None) -> StepResult:
    name, source = "team_home_away_summary", "fact_team_match_statistics"
    return _build_mart(spark, lake, name, marts.team_home_away_summary, source, seasons=seasons)


def build_top_scorers_by_season(spark: SparkSession, lake: Lake, seasons: Seasons = None) -> StepResult:
    return _build_mart(spark, lake, "top_scorers_by_season", marts.top_scorers_by_season, "fact_goals", seasons=seasons)


def build_team_discipline_summary(spark: SparkSession, lake: Lake, seasons: Seasons = None) -> StepResult:
    name, sources = "team_discipline_summary", ("fact_cards", "fact_team_match_statistics")
    return _build_mart(spark, lake, name, marts.team_discipline_summary, *sources, seasons=seasons)


SILVER_STEPS = {
    "matches": build_silver_matches,
    "goals": build_silver_goals,
    "cards": build_silver_cards,
    "match_statistics": build_silver_match_statistics,
}
FACT_STEPS = {
    "fact_matches": build_fact_matches,
    "fact_goals": build_fact_goals,
    "fact_cards": build_fact_cards,
    "fact_team_match_statistics": build_fact_team_match_statistics,
}
MART_STEPS = {
    "team_season_summary": build_team_season_summary,
    "team_home_away_summary": build_team_home_away_summary,
    "top_scorers_by_season": build_top_scorers_by_season,
    "team_discipline_summary": build_team_discipline_summary,
}


#: Facts that a mart is made of.
MART_SOURCES = {
    "team_season_summary": ("fact_team_match_statistics",),
    "team_home_away_summary": ("fact_team_match_statistics",),
    "top_scorers_by_season": ("fact_goals",),
    "team_discipline_summary": ("fact_cards", "fact_team_match_statistics"),
}


def run_all(
    spark: SparkSession, lake: Lake, load_date: str | None = None, incremental: bool = False
) -> dict[str, StepResult]:
    """All steps in dependency order.

    An ``incremental`` run derives the cleaned tables and facts in full, but counts failing checks only in seasons whose
    rows no earlier run has counted, writes only the seasons in which the tables differ from what is published, and makes
    the marts anew for those seasons alone. The result equals a full run's except for lineage: an unchanged season keeps
    naming the files of the load that brought it.
    """
    return run_steps(spark, lake, {*SILVER_STEPS, *FACT_STEPS, *MART_STEPS}, load_date, incremental)


def run_steps(
    spark: SparkSession, lake: Lake, wanted: Collection[str], load_date: str | None = None, incremental: bool = False
) -> dict[str, StepResult]:
    """Some steps in dependency order; ``run_all`` says what an incremental run does."""
    results = {
        name: step(spark, lake, load_date, incremental=incremental) for name, step in SILVER_STEPS.items() if name in wanted
    }
    results |= {name: step(spark, lake, incremental) for name, step in FACT_STEPS.items() if name in wanted}
    for name, step in MART_STEPS.items():
        if name not in wanted:
            continue
        seasons = None
        if incremental and path_exists(spark, lake.mart(name)):
            touched = {season for source in MART_SOURCES[name] if source in results for season in results[source].seasons}
            seasons = sorted(touched, key=lambda season: (season is not None, season))
        results[name] = step(spark, lake, seasons)
    return results
