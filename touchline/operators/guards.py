"""Input guards."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_rows(frame: DataFrame, what: str) -> DataFrame:
    """Return the frame, or raise if it holds no row."""
    if frame.isEmpty():
        raise ValueError(f"no rows in {what}")
    return frame
