"""Cleaned and typed tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import parse_date, parse_timestamp
from touchline.functions.keys import digest_id
from touchline.functions.minutes import minute_bucket, parse_minute
from touchline.functions.numbers import ratio
from touchline.functions.outcomes import by_side, is_home_side, known_result, lookup, result_or_draw
from touchline.operators.layout import project
from touchline.operators.numbering import ROWS_PER_TASK, HotBuckets, measure_hot_buckets, number_occurrences
from touchline.plans import layouts

# The columns of each table, in order.
MATCHES_COLUMNS = (
    "match_id",
    "round",
    "match_time",
    "home_team",
    "away_team",
    "home_formation",
    "away_formation",
    "home_coach",
    "away_coach",
    "winner",
    "stadium",
    "home_score",
    "away_score",
    "home_state",
    "away_state",
    "gross_revenue",
    "ingestion_date",
    "source_file",
    "match_date",
    "match_datetime",
    "season",
    "total_goals",
    "is_draw",
    "home_result",
    "away_result",
    "winner_normalized",
)

GOALS_COLUMNS = (
    "goal_id",
    "match_id",
    "round",
    "season",
    "match_date",
    "team",
    "player",
    "minute_raw",
    "minute_base",
    "stoppage_minute",
    "minute",
    "minute_bucket",
    "goal_type",
    "is_home_team_goal",
    "ingestion_date",
    "source_file",
)

CARDS_COLUMNS = (
    "card_id",
    "match_id",
    "round",
    "season",
    "match_date",
    "team",
    "player",
    "shirt_number",
    "position",
    "minute_raw",
    "minute_base",
    "stoppage_minute",
    "minute",
    "minute_bucket",
    "card_type",
    "card_weight",
    "is_home_team_card",
    "ingestion_date",
    "source_file",
)

STATISTICS_COLUMNS = (
    "match_id",
    "round",
    "season",
    "match_date",
    "team",
    "opponent_team",
    "is_home_team",
    "match_result",
    "goals_scored",
    "goals_conceded",
    "shots",
    "shots_on_target",
    "shot_accuracy",
    "scoring_efficiency",
    "possession",
    "passes",
    "pass_accuracy",
    "fouls",
    "yellow_cards",
    "red_cards",
    "offsides",
    "corners",
    "ingestion_date",
    "source_file",
)

EVENT_MATCH_COLUMNS = ("match_id", "season", "match_date", "home_team", "away_team")
STATISTICS_MATCH_COLUMNS = (*EVENT_MATCH_COLUMNS, "home_score", "away_score")

# Events that agree on all of these are told apart by their occurrence number.
GOAL_IDENTITY = ("match_id", "team", "player", "minute", "goal_type")


# Distributes the rows of a table, once they have their season, before columns are derived that need not travel.
Arrange = Callable[[DataFrame], DataFrame]


def as_they_come(rows: DataFrame) -> DataFrame:
    return rows


def silver_matches(raw: DataFrame, arrange: Arrange = as_they_come) -> DataFrame:
    """One row per match. Projections only, no shuffle but what ``arrange`` does."""
    typed = project(raw, layouts.MATCHES)
    home, away = F.col("home_score"), F.col("away_score")
    dated = typed.withColumn("match_date", parse_date(F.col("match_date_raw")))
    return arrange(dated.withColumn("season", F.year("match_date"))).withColumns(
        {
            "match_datetime": parse_timestamp(F.col("match_date_raw"), F.col("match_time")),
            "total_goals": F.try_add(home, away),
            "is_draw": home == away,
            "home_result": result_or_draw(home, away),
            "away_result": result_or_draw(away, home),
            "winner_normalized": F.nullif(F.col("winner"), F.lit(layouts.NO_WINNER)),
        }
    ).select(*MATCHES_COLUMNS)


def _with_raw_minute(events: DataFrame) -> DataFrame:
    return events.withColumn("minute_raw", parse_minute(F.col("minute_text")).raw).drop("minute_text")


def _with_parsed_minute(events: DataFrame) -> DataFrame:
    """What ``minute_raw`` says; it may be read again, so that the numbers need not be shuffled."""
    minute = parse_minute(F.col("minute_raw"))
    return events.withColumns(
        {"minute_base": minute.base, "stoppage_minute": minute.stoppage, "minute": minute.exact}
    )


def _with_minutes(events: DataFrame) -> DataFrame:
    return _with_parsed_minute(_with_raw_minute(events))


def _with_match(events: DataFrame, matches: DataFrame, columns: tuple[str, ...], side: str) -> DataFrame:
    """Left join to the match. Events of an unknown match stay, with nulls.

    Spark broadcasts the matches if they turn out small and splits skewed keys of the events if not.
    """
    joined = events.join(matches.select(*columns), "match_id", "left")
    return joined.withColumn(side, is_home_side(F.col("team"), F.col("home_team"), F.col("away_team")))


def _with_side(events: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    """Events with the season and date of their match; of its teams only which of the two the event's is."""
    return _with_match(events, matches, EVENT_MATCH_COLUMNS, side).drop("home_team", "away_team")


def measure_goals(raw: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> HotBuckets:
    """Match keys under which too many goals gather for one task; only the key column is used."""
    return measure_hot_buckets(project(raw, [layouts.MATCH_KEY]), ["match_id"], rows_per_task)


def goals_without_ids(raw: DataFrame, matches: DataFrame) -> DataFrame:
    """The goals without ``goal_id``, for work that needs none: nothing is numbered or distributed by match."""
    goals = _with_side(_with_minutes(project(raw, layouts.GOALS)), matches, "is_home_team_goal")
    bucketed = goals.withColumn("minute_bucket", minute_bucket(F.col("minute")))
    return bucketed.select(*[column for column in GOALS_COLUMNS if column != "goal_id"])


def silver_goals(
    raw: DataFrame,
    matches: DataFrame,
    hot: HotBuckets | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    arrange: Arrange = as_they_come,
) -> DataFrame:
    """One row per goal.

    The goals are distributed once, by match key: numbering and the join to matches share that shuffle.
    """
    hot = measure_goals(raw, rows_per_task) if hot is None else hot
    typed = _with_raw_minute(project(raw, layouts.GOALS))
    numbered = number_occurrences(
        typed, GOAL_IDENTITY, ["source_file"], "occurrence", hot, rows_per_task, derive=_with_parsed_minute
    )
    parts = [_with_side(part, matches, "is_home_team_goal") for part in numbered]
    arranged = arrange(reduce(DataFrame.unionByName, parts).drop("minute_base", "stoppage_minute", "minute"))
    return (
        _with_parsed_minute(arranged)
        .withColumns(
            {
                "minute_bucket": minute_bucket(F.col("minute")),
                "goal_id": digest_id(*map(F.col, [*GOAL_IDENTITY, "occurrence"])),
            }
        )
        .select(*GOALS_COLUMNS)
    )


def silver_cards(raw: DataFrame, matches: DataFrame, arrange: Arrange = as_they_come) -> DataFrame:
    """One row per card. Identical cards share an identifier."""
    cards = arrange(_with_side(project(raw, layouts.CARDS), matches, "is_home_team_card"))
    identity = ("match_id", "team", "player", "shirt_number", "position", "minute", "card_type")
    return (
        _with_minutes(cards)
        .withColumns(
            {
                "minute_bucket": minute_bucket(F.col("minute")),
                "card_weight": lookup(F.col("card_type"), layouts.CARD_WEIGHTS),
                "card_id": digest_id(*map(F.col, identity)),
            }
        )
        .select(*CARDS_COLUMNS)
    )


def silver_match_statistics(raw: DataFrame, matches: DataFrame, arrange: Arrange = as_they_come) -> DataFrame:
    """One row per match and team, seen from that team."""
    stats = _with_match(
        project(raw, layouts.MATCH_STATISTICS), matches, STATISTICS_MATCH_COLUMNS, "is_home_team"
    )
    at_home = F.col("is_home_team")
    seen = stats.withColumns(
        {
            "opponent_team": by_side(at_home, F.col("away_team"), F.col("home_team")),
            "goals_scored": by_side(at_home, F.col("home_score"), F.col("away_score")),
            "goals_conceded": by_side(at_home, F.col("away_score"), F.col("home_score")),
        }
    )
    return arrange(seen.drop("home_team", "away_team", "home_score", "away_score")).withColumns(
        {
            "match_result": known_result(F.col("goals_scored"), F.col("goals_conceded")),
            "shot_accuracy": ratio(F.col("shots_on_target"), F.col("shots")),
            "scoring_efficiency": ratio(F.col("goals_scored"), F.col("shots")),
        }
    ).select(*STATISTICS_COLUMNS)
