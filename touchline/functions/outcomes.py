"""Sides, results, points and flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Result labels and the points each earns.
WIN, DRAW, LOSS = "win", "draw", "loss"
RESULT_POINTS = {WIN: 3, DRAW: 1, LOSS: 0}


def result_or_draw(scored: Column, conceded: Column) -> Column:
    """Result of a side; anything that is neither a win nor a loss, unknown scores too, is a draw."""
    return F.when(scored > conceded, WIN).when(scored < conceded, LOSS).otherwise(DRAW)


def known_result(scored: Column, conceded: Column) -> Column:
    """Result of a side; null when either score is unknown."""
    return F.when(scored > conceded, WIN).when(scored < conceded, LOSS).when(scored == conceded, DRAW)


def is_home_side(team: Column, home: Column, away: Column) -> Column:
    """True for the home team, false for the away team, null for a team in neither side."""
    return F.when(team == home, F.lit(True)).when(team == away, F.lit(False))


def by_side(is_home: Column, if_home, if_away) -> Column:
    """Pick a value by side; null when the side is unknown."""
    return F.when(is_home, if_home).when(~is_home, if_away)


def lookup(value: Column, table: Mapping[str, int]) -> Column:
    """Map known texts to integers; null for any other."""
    result = None
    for key, mapped in table.items():
        result = (F if result is None else result).when(value == key, F.lit(mapped))
    return result


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
