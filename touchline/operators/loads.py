"""Choice of one load among several."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD_DATE = "_load_date"


def choose_load_date(available: Iterable[str | None], wanted: str | None = None) -> str:
    """The wanted load date if it exists, else the latest; dates compare as text."""
    dates = {date for date in available if date}
    if wanted:
        if wanted not in dates:
            raise ValueError(f"no files for load date {wanted}")
        return wanted
    if not dates:
        raise ValueError("no load date found")
    return max(dates)


def select_load(raw: DataFrame, wanted: str | None = None, column: str = LOAD_DATE) -> DataFrame:
    """Rows of one load of a frame that already carries its load date.

    The latest date is one scalar brought to the driver, so the filter is a literal that Spark can push
    into the scan. Files are better chosen by directory (see ``sources.bronze``), which reads no other load.
    """
    if wanted:
        chosen = raw.filter(F.col(column) == wanted)
        if chosen.isEmpty():
            raise ValueError(f"no files for load date {wanted}")
        return chosen
    latest = raw.agg(F.max(column)).first()[0]
    return raw.filter(F.col(column) == choose_load_date([latest]))
