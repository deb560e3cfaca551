"""Text cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_BREAK_SPACE = "\u00a0"


def clean_text(value: Column) -> Column:
    """Turn no-break spaces into spaces, trim, and read an empty result as null."""
    spaced = F.replace(value, F.lit(NO_BREAK_SPACE), F.lit(" "))
    return F.nullif(F.trim(spaced), F.lit(""))


def relabel(value: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Lower and trim ``value``, then map each known spelling to its label; other text is kept."""
    folded = F.lower(F.trim(value))
    result = folded
    for label, known in spellings.items():
        result = F.when(folded.isin(*known), F.lit(label)).otherwise(result)
    return result
