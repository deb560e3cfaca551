"""Quality suites of the pipeline. Check names are fixed values: they appear in reports and quarantine paths."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.outcomes import RESULT_POINTS, flag, lookup, result_or_draw
from touchline.operators.integrity import reconcile_counts
from touchline.operators.quality import WARNING, Check, FrameCheck, GroupCheck, RowCheck, repeated
from touchline.plans import layouts

# Limits the checks use.
LAST_PLAUSIBLE_MINUTE = 130
ROWS_PER_MATCH = 2

col = F.col


def _missing(*columns: str, severity: str = "critical") -> list[RowCheck]:
    return [RowCheck(f"null_{name}", col(name).isNull(), severity) for name in columns]


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _negative(*columns: str) -> Column:
    return _any([col(name) < 0 for name in columns])


def _outside(column: str, low: int, high: int) -> Column:
    return (col(column) < low) | (col(column) > high)


def _same_teams() -> Column:
    return col("home_team") == col("away_team")


def _unknown_score() -> Column:
    return col("home_score").isNull() | col("away_score").isNull()


def _total_differs() -> Column:
    return col("total_goals") != F.try_add("home_score", "away_score")


def _draw_differs() -> Column:
    return col("is_draw") != (col("home_score") == col("away_score"))


def _winner_is_neither(winner: str) -> Column:
    """No winner, or one that is neither team. Unknown teams leave it undecided."""
    neither = (col(winner) != col("home_team")) & (col(winner) != col("away_team"))
    return col(winner).isNull() | neither


def _unknown_label(column: str, labels: Sequence[str]) -> Column:
    return ~col(column).isin(*labels)


def silver_matches_gate() -> list[Check]:
    """What must hold before matches are written."""
    winner, draw = col("winner"), col("is_draw")
    return [
        repeated("duplicate_match_id", "match_id"),
        *_missing("match_id", "match_date", "season"),
        RowCheck("same_home_away_team", _same_teams()),
        RowCheck("negative_scores", _negative("home_score", "away_score")),
        RowCheck("draw_with_winner", draw & winner.isNotNull() & (winner != layouts.NO_WINNER)),
        RowCheck("non_draw_invalid_winner", ~draw & _winner_is_neither("winner")),
    ]


def silver_matches() -> list[Check]:
    """Full report on matches, with warnings."""
    home, away, draw = col("home_score"), col("away_score"), col("is_draw")
    return [
        *_missing("match_id"),
        repeated("duplicate_match_id", "match_id", ignore_null_keys=True),
        *_missing("match_date", "season", "home_team", "away_team"),
        RowCheck("same_home_away_team", _same_teams()),
        RowCheck("null_scores", _unknown_score()),
        RowCheck("negative_scores", _negative("home_score", "away_score")),
        RowCheck("season_mismatch", col("season") != F.year("match_date")),
        RowCheck("total_goals_mismatch", _total_differs()),
        RowCheck("is_draw_mismatch", _draw_differs()),
        RowCheck("home_result_mismatch", col("home_result") != result_or_draw(home, away)),
        RowCheck("away_result_mismatch", col("away_result") != result_or_draw(away, home)),
        RowCheck("draw_with_winner", draw & col("winner_normalized").isNotNull()),
        RowCheck("non_draw_invalid_winner", ~draw & _winner_is_neither("winner_normalized")),
        *_missing("match_datetime", "home_coach", "away_coach", "gross_revenue", severity=WARNING),
    ]


def _event_checks(side: str) -> list[Check]:
    return [
        *_missing("match_id", "team", "player", "season"),
        RowCheck("invalid_team_for_match", col(side).isNull()),
        *_missing("minute"),
        RowCheck("negative_minute", _negative("minute")),
        RowCheck("minute_too_high", col("minute") > LAST_PLAUSIBLE_MINUTE),
    ]


def goal_reconciliation(goals: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches whose number of goal events differs from their score."""
    return reconcile_counts(matches, goals, "match_id", "total_goals", "goal_events")


def silver_goals(goals: DataFrame, matches: DataFrame) -> list[Check]:
    return [
        *_event_checks("is_home_team_goal"),
        repeated("duplicate_goal_id", "goal_id"),
        FrameCheck("goal_count_mismatch_vs_matches", goal_reconciliation(goals, matches)),
    ]


def silver_cards() -> list[Check]:
    wrong_weights = [
        (col("card_type") == label) & (col("card_weight") != weight)
        for label, weight in layouts.CARD_WEIGHTS.items()
    ]
    return [
        *_event_checks("is_home_team_card"),
        RowCheck("invalid_card_type", _unknown_label("card_type", list(layouts.CARD_WEIGHTS))),
        RowCheck("invalid_card_weight", _any(wrong_weights)),
        RowCheck("invalid_shirt_number", col("shirt_number") <= 0),
        repeated("duplicate_card_id", "card_id"),
    ]


def _two_rows_per_match() -> GroupCheck:
    return GroupCheck("rows_per_match_not_equal_2", ("match_id",), lambda n: n != ROWS_PER_MATCH)


def silver_match_statistics() -> list[Check]:
    counters = (
        "shots",
        "shots_on_target",
        "passes",
        "fouls",
        "yellow_cards",
        "red_cards",
        "offsides",
        "corners",
    )
    expected = result_or_draw(col("goals_scored"), col("goals_conceded"))
    return [
        *_missing("match_id", "team", "season"),
        RowCheck("invalid_team_for_match", col("is_home_team").isNull()),
        repeated("duplicate_match_team_rows", "match_id", "team"),
        _two_rows_per_match(),
        RowCheck("shots_on_target_greater_than_shots", col("shots_on_target") > col("shots")),
        RowCheck("invalid_possession_range", _outside("possession", 0, 100)),
        RowCheck("invalid_pass_accuracy_range", _outside("pass_accuracy", 0, 100)),
        RowCheck("negative_numeric_stats", _negative(*counters)),
        RowCheck("goals_scored_mismatch_vs_result", col("match_result") != expected),
    ]


def fact_matches() -> list[Check]:
    return [
        *_missing("match_id"),
        repeated("duplicate_match_id", "match_id"),
        *_missing("match_date", "season", "home_team", "away_team"),
        RowCheck("same_home_away_team", _same_teams()),
        RowCheck("null_scores", _unknown_score()),
        RowCheck("negative_scores", _negative("home_score", "away_score")),
        RowCheck("total_goals_mismatch", _total_differs()),
        RowCheck("is_draw_mismatch", _draw_differs()),
        RowCheck("home_points_mismatch", col("match_points_home") != lookup(col("home_result"), RESULT_POINTS)),
        RowCheck("away_points_mismatch", col("match_points_away") != lookup(col("away_result"), RESULT_POINTS)),
        RowCheck("draw_flag_mismatch", col("draw_flag") != flag(col("is_draw"))),
    ]


def fact_goals() -> list[Check]:
    return [
        *_missing("goal_id", "match_id", "team", "season"),
        repeated("duplicate_goal_id", "goal_id"),
        RowCheck("negative_minute", _negative("minute")),
    ]


def fact_cards() -> list[Check]:
    return [
        *_missing("card_id", "match_id", "team", "season"),
        repeated("duplicate_card_id", "card_id"),
        RowCheck("invalid_card_type", _unknown_label("card_type", list(layouts.CARD_WEIGHTS))),
        RowCheck("negative_minute", _negative("minute")),
    ]


def fact_team_match_statistics() -> list[Check]:
    return [
        *_missing("match_id", "team", "season", "match_result"),
        RowCheck("same_team_opponent", col("team") == col("opponent_team")),
        repeated("duplicate_match_team", "match_id", "team"),
        _two_rows_per_match(),
        RowCheck("invalid_match_side", _unknown_label("match_side", ["home", "away"])),
        RowCheck("negative_goals", _negative("goals_scored", "goals_conceded")),
    ]
