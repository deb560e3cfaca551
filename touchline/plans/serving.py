"""Relational serving: which tables, in which order, in which shape."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.layout import Target, conform
from touchline.plans.marts import home_away_wide
from touchline.sources.jdbc import JdbcTarget, write_jdbc
from touchline.sources.lake import Lake
from touchline.sources.tables import read_table

# Referenced tables come before those that refer to them.
FACT_TABLES = ("fact_matches", "fact_goals", "fact_cards")
MART_TABLES = (
    "team_season_summary",
    "team_home_away_summary",
    "top_scorers_by_season",
    "team_discipline_summary",
)

# Keys the relational schema declares.
PRIMARY_KEYS = {
    "fact_matches": ("match_id",),
    "fact_goals": ("goal_id",),
    "fact_cards": ("card_id",),
    "team_season_summary": ("season", "team"),
    "team_home_away_summary": ("season", "team"),
    "top_scorers_by_season": ("season", "player", "team"),
    "team_discipline_summary": ("season", "team"),
}


def _column(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _same(type_: str, *names: str) -> list[Target]:
    return [Target(name, type_, _column(name)) for name in names]


def _renamed(type_: str, name: str, source: str) -> Target:
    return Target(name, type_, _column(source))


_EVENT_MINUTES = [
    _renamed("int", "minute", "minute_base"),
    _renamed("int", "minute_extra", "stoppage_minute"),
    _renamed("int", "minute_exact", "minute"),
]

# Columns and types the relational schema declares. Which computed column fills each is our reading.
DECLARED: dict[str, Sequence[Target]] = {
    "fact_matches": [
        *_same("string", "match_id"),
        *_same("int", "season", "round"),
        Target("date", "timestamp", lambda: F.coalesce("match_datetime", F.col("match_date").cast("timestamp"))),
        *_same("string", "home_team", "away_team"),
        *_same("int", "home_score", "away_score"),
    ],
    "fact_goals": [*_same("string", "goal_id", "match_id", "team", "player"), *_EVENT_MINUTES],
    "fact_cards": [*_same("string", "card_id", "match_id", "team", "player", "card_type"), *_EVENT_MINUTES],
    "team_season_summary": [
        *_same("int", "season"),
        *_same("string", "team"),
        *_same("int", "matches", "wins", "draws", "losses", "goals_for", "goals_against"),
        _renamed("int", "goal_diff", "goal_difference"),
        *_same("int", "points"),
    ],
    "top_scorers_by_season": [
        *_same("int", "season"),
        *_same("string", "player", "team"),
        *_same("int", "goals"),
    ],
    "team_discipline_summary": [
        *_same("int", "season"),
        *_same("string", "team"),
        _renamed("int", "yellow_cards", "yellow_cards_events"),
        _renamed("int", "red_cards", "red_cards_events"),
        *_same("int", "fouls"),
    ],
}


def declared_shape(table: str, frame: DataFrame) -> DataFrame:
    """A gold table in the columns and types the relational schema declares."""
    return conform(frame, DECLARED[table])


def serving_tables(
    spark: SparkSession, lake: Lake, declared: bool = False
) -> list[tuple[str, DataFrame]]:
    """The tables to serve, in load order: as computed, or in the declared shape."""
    tables = []
    for name in (*FACT_TABLES, *MART_TABLES):
        path = lake.gold_table(name) if name in FACT_TABLES else lake.mart(name)
        if not declared:
            tables.append((name, read_table(spark, path)))
        elif name == "team_home_away_summary":
            tables.append((name, home_away_wide(read_table(spark, path))))
        else:
            tables.append((name, declared_shape(name, read_table(spark, path))))
    return tables


def serve(
    spark: SparkSession,
    lake: Lake,
    target: JdbcTarget,
    declared: bool = False,
    write: Callable[[DataFrame, JdbcTarget, str], None] = write_jdbc,
) -> list[str]:
    """Load all tables in order and return their names.

    Only tables of the declared shape fit the declared schema, so others replace their table instead of emptying it.
    """
    target = replace(target, truncate=target.truncate and declared)
    names = []
    for name, frame in serving_tables(spark, lake, declared):
        write(frame, target, name)
        names.append(name)
    return names
