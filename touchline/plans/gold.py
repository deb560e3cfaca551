"""Fact tables: cleaned tables without their lineage columns, plus points and flags. No shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.outcomes import DRAW, LOSS, RESULT_POINTS, WIN, by_side, flag, lookup
from touchline.plans import silver

LINEAGE_COLUMNS = ("ingestion_date", "source_file")

# The columns taken over from matches, in order.
FACT_MATCHES_COLUMNS = (
    "match_id",
    "round",
    "match_date",
    "match_time",
    "match_datetime",
    "season",
    "home_team",
    "away_team",
    "home_formation",
    "away_formation",
    "home_coach",
    "away_coach",
    "winner",
    "winner_normalized",
    "stadium",
    "home_score",
    "away_score",
    "home_state",
    "away_state",
    "gross_revenue",
    "is_draw",
    "home_result",
    "away_result",
    "total_goals",
)
FACT_GOALS_COLUMNS = [c for c in silver.GOALS_COLUMNS if c not in LINEAGE_COLUMNS]
FACT_CARDS_COLUMNS = [c for c in silver.CARDS_COLUMNS if c not in LINEAGE_COLUMNS]
FACT_STATISTICS_COLUMNS = [c for c in silver.STATISTICS_COLUMNS if c not in LINEAGE_COLUMNS]


def fact_matches(matches: DataFrame) -> DataFrame:
    home, away = F.col("home_result"), F.col("away_result")
    return matches.select(
        *FACT_MATCHES_COLUMNS,
        lookup(home, RESULT_POINTS).alias("match_points_home"),
        lookup(away, RESULT_POINTS).alias("match_points_away"),
        flag(home == WIN).alias("home_win_flag"),
        flag(away == WIN).alias("away_win_flag"),
        flag(F.col("is_draw")).alias("draw_flag"),
    )


def fact_goals(goals: DataFrame) -> DataFrame:
    return goals.select(*FACT_GOALS_COLUMNS)


def fact_cards(cards: DataFrame) -> DataFrame:
    return cards.select(*FACT_CARDS_COLUMNS)


def fact_team_match_statistics(statistics: DataFrame) -> DataFrame:
    result = F.col("match_result")
    return statistics.select(
        *FACT_STATISTICS_COLUMNS,
        by_side(F.col("is_home_team"), F.lit("home"), F.lit("away")).alias("match_side"),
        lookup(result, RESULT_POINTS).alias("match_points"),
        flag(result == WIN).alias("win_flag"),
        flag(result == DRAW).alias("draw_flag"),
        flag(result == LOSS).alias("loss_flag"),
        flag(F.col("goals_conceded") == 0).alias("clean_sheet_flag"),
    )
