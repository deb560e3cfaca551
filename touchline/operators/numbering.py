"""Occurrence numbers inside groups of equal events, safe when one group is huge.

A plain ``row_number`` puts each group in one task. That is right for the near-unique groups expected here,
but one bad value can gather a large part of all rows. So the rows are counted over a fixed number of hash buckets,
combined map-side; buckets that hold too much for one task are *hot*. Rows outside them take the plain window. Rows
inside take a route that never holds a bucket in one task, nor a group that is too large for one. Their groups are counted
by hash, map-side: those that fit stay whole and are dealt over the pieces of their bucket, which shuffles them once. The
others are cut: equal rows are counted, the counts are summed into ranges piece by piece, and the ranges are expanded
after being spread again. Two groups of one hash count together, so at most a group is cut without need.

Nothing runs when the plan is made: the hot buckets are a frame of the same plan, at most one row per ``ROWS_PER_TASK``
rows and never more than ``BUCKETS``, so it is broadcast; so are the groups to cut, at most one row per ``ROWS_PER_TASK``
rows. Where one turns out empty, adaptive execution drops what it leads to before that reads anything.

Both routes number a group in the same order: the given columns, then the MD5 of the remaining columns, then
those. A piece is a range of that MD5, so the number a row gets depends neither on the route nor on the number
of pieces, and a load that grows keeps its numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ordinary groups fill a bucket to ROWS_PER_TASK only beyond 2e12 rows; then all rows take the route in pieces.
BUCKETS = 1 << 20
ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class HotBuckets:
    """Hash buckets of some keys with too many rows for one task: a frame of ``_bucket`` and the ``_pieces`` to cut it in."""

    keys: tuple[str, ...]
    buckets: DataFrame


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _digest(columns: Sequence[str]) -> Column:
    """MD5 of some columns as text, in order of their names; null counts as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns)]))


def measure_hot_buckets(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> HotBuckets:
    """Plan the count of rows per hash bucket of the keys. Of a columnar source only the keys are read."""
    counts = rows.groupBy(_bucket(keys).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.greatest(F.lit(2), F.ceil(F.col("_n") / rows_per_task)).cast("bigint").alias("_pieces")
    return HotBuckets(tuple(keys), counts.where(F.col("_n") > rows_per_task).select("_bucket", pieces))


def number_occurrences(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str,
    hot: HotBuckets,
    rows_per_task: int = ROWS_PER_TASK,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> list[DataFrame]:
    """Number the rows of each key group, in two frames: plain rows, then hot rows.

    ``derive`` makes columns of others of the same row, keys among them but for those of ``hot``; it is applied after the
    shuffle, so that they need not travel.

    ``hot`` must be found by a subset of ``keys``. A group of hot rows is cut in the pieces of its bucket if it has more than
    ``rows_per_task`` rows. The plain frame is distributed by those columns, so a
    following join on them needs no second shuffle; keep the frames apart until after that join.
    """
    if not set(hot.keys) <= set(keys):
        raise ValueError(f"hot buckets over {hot.keys} do not cover whole groups of {tuple(keys)}")
    columns = rows.columns
    rest = [c for c in derive(rows).columns if c not in keys and c not in order_by]
    window = Window.partitionBy(*keys).orderBy(*order_by, _digest(rest), *rest)
    placed = rows.withColumn("_bucket", _bucket(hot.keys))
    plain = placed.join(F.broadcast(hot.buckets), "_bucket", "left_anti").select(*columns)
    crowded = placed.join(F.broadcast(hot.buckets), "_bucket").select(*columns, "_pieces")
    grouped = derive(crowded).select("*", F.xxhash64(*keys).alias("_group")).select(*columns, "_pieces", "_group")
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    huge = F.broadcast(sizes.where(F.col("_n") > rows_per_task).select("_group"))
    piece = F.pmod("_group", F.col("_pieces")).cast("int").alias("_piece")
    whole = grouped.join(huge, "_group", "left_anti").select(*columns, piece).repartition(*hot.keys, "_piece")
    in_piece = Window.partitionBy(*keys, "_piece").orderBy(*order_by, _digest(rest), *rest)
    cut = grouped.join(huge, "_group").select(*columns, "_pieces")
    return [
        derive(plain.repartition(*hot.keys)).withColumn(name, F.row_number().over(window)),
        derive(whole).withColumn(name, F.row_number().over(in_piece)).drop("_piece").unionByName(
            _number_in_pieces(derive(cut), keys, order_by, name, rows_per_task)
        ),
    ]


def _join_null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], added: str) -> DataFrame:
    """Left rows plus ``added`` from a frame with one row per ``columns``; nulls are equal."""
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])
    return left.join(right, same, "inner").select(*[left[c] for c in left.columns], right[added])


def _number_in_pieces(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str,
    rows_per_task: int,
) -> DataFrame:
    """Number rows whose group is cut in ``_pieces``, the same for all rows of a group."""
    columns = [c for c in rows.columns if c != "_pieces"]
    payload = [c for c in columns if c not in keys and c not in order_by]
    # Copies of a row are interchangeable: keep one with its count. The count combines map-side.
    packed = rows.groupBy(*columns, "_pieces").agg(F.count(F.lit(1)).alias("_copies"))
    # A piece is a range of the digest: pieces in order hold rows in order.
    leading = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint")
    packed = packed.withColumn("_digest", _digest(payload)).withColumn("_piece", F.shiftright(leading * F.col("_pieces"), 32))

    group, run, slot = list(keys), [*keys, *order_by], [*keys, *order_by, "_piece"]

    def before(partition: Sequence[str], order: Sequence[str], value: str) -> Column:
        span = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(span), F.lit(0).cast("bigint"))

    piece_totals = packed.groupBy(*slot).agg(F.sum("_copies").alias("_n"))
    run_totals = piece_totals.groupBy(*run).agg(F.sum("_n").alias("_n"))
    run_starts = run_totals.withColumn("_run_start", before(group, order_by, "_n")).drop("_n")
    piece_starts = piece_totals.withColumn("_piece_start", before(run, ["_piece"], "_n")).drop("_n")
    # Only the totals are joined on the group; the rows are joined on their piece, which no task finds large.
    starts = _join_null_safe(piece_starts, run_starts, run, "_run_start").select(
        *slot, (F.col("_run_start") + F.col("_piece_start")).alias("_start")
    )

    placed = packed.withColumn("_row_start", before(slot, ["_digest", *payload], "_copies"))
    placed = _join_null_safe(placed, starts, slot, "_start")
    first = F.col("_start") + F.col("_row_start")

    # Expand in two steps with a shuffle between, so one row's many copies are written by many tasks.
    step = F.lit(rows_per_task).cast("bigint")
    parts = placed.select(
        *columns,
        first.alias("_first"),
        "_copies",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, step)).alias("_from"),
    ).repartition(*columns, "_from")
    until = F.least(F.col("_from") + step, F.col("_copies")) - 1
    return parts.select(
        *columns, "_first", F.explode(F.sequence(F.col("_from"), until)).alias("_i")
    ).select(*columns, (F.col("_first") + F.col("_i") + 1).alias(name))
