"""Run metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(column: str):
    """Number of distinct values, with null as a value of its own."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def run_metrics(frame: DataFrame, distinct: Mapping[str, str]) -> DataFrame:
    """One row: ``rows`` and, per metric name, the distinct values of a column.

    Rows are first counted per combination of the columns, map-side, so that the several distinct counts, each of which
    goes over its input again, go over combinations only.
    """
    columns = list(dict.fromkeys(distinct.values()))
    if not columns:
        return frame.agg(F.count(F.lit(1)).alias("rows"))
    groups = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
        *[distinct_values(column).cast("bigint").alias(name) for name, column in distinct.items()],
    )
