"""Keys, references and counts across tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_groups(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, with their ``count``."""
    return frame.groupBy(*keys).count().filter(F.col("count") > 1)


def key_report(frame: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: how many key groups repeat, and how many rows have a null in the key."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    groups = frame.groupBy(*keys).count()
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(keys)).alias("key_columns"),
        F.count_if(F.col("count") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(any_null, F.col("count"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys that no parent row has, with their row count; a null key refers to nothing and passes.

    Children are counted per key before the join, so a key with many rows travels as one row.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return counted.join(parent.select(key), key, "left_anti")


def reconcile_counts(
    parent: DataFrame, child: DataFrame, key: str, expected: str, counted_as: str
) -> DataFrame:
    """Parent rows whose number of child rows differs from the expected number; no child row counts as 0."""
    events = child.groupBy(key).agg(F.count(F.lit(1)).alias(counted_as))
    return (
        parent.select(key, expected)
        .join(events, key, "left")
        .fillna({counted_as: 0})
        .filter(F.col(counted_as) != F.col(expected))
    )
