"""Parquet tables partitioned by season."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.sources.storage import delete_path, join_path, path_exists

PARTITION = "season"
#: Identifiers are digests in hexadecimal, which Spark's default, Snappy, leaves at twice their size.
COMPRESSION = "zstd"
#: Fixed value: how Spark names the folder of a null.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    seasons: Sequence[int | None] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a table, optionally some columns and some seasons; both reach the scan.

    A table whose every season is null has no value to infer the partition type from, so it is cast.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    table = reader.parquet(path)
    if PARTITION in table.columns and dict(table.dtypes)[PARTITION] != "int":
        table = table.withColumn(PARTITION, F.col(PARTITION).cast("int"))
    if seasons is not None:
        table = table.filter(in_seasons(seasons))
    if columns is not None:
        return table.select(*columns)
    return table.select(*schema.names) if schema is not None else table


def gathered(frame: DataFrame, partition_by: Sequence[str] = (PARTITION,)) -> DataFrame:
    """The frame with rows of a partition brought together; columns added to it later are not shuffled."""
    return frame.hint("rebalance", *partition_by)


def write_table(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str] = (PARTITION,),
    gather: bool = False,
    dynamic: bool = False,
) -> None:
    """Overwrite a partitioned table.

    ``gather`` brings rows of a partition together first, so that a wide scan does not leave a small file
    per task and season. It is a rebalance, not a repartition: a season far above the target size is split
    over many tasks. Leave it off where the input is already laid out by season, or small.
    ``dynamic`` replaces only the partitions present in the frame.
    """
    if gather:
        frame = gathered(frame, partition_by)
    writer = frame.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def in_seasons(seasons: Sequence[int | None]) -> Column:
    """Whether a row is of one of some seasons; null is one too."""
    known = F.col(PARTITION).isin(*[season for season in seasons if season is not None])
    return (known | F.col(PARTITION).isNull()) if None in seasons else F.coalesce(known, F.lit(False))


def season_digests(table: DataFrame, ignore: Collection[str] = (), also: Sequence[Column] = ()) -> DataFrame:
    """Per season the number of rows and two digests of them that do not depend on their order, and other aggregates.

    Hashes are summed as exact decimals and combined bit by bit, map-side; one row a season is shuffled.
    """
    columns = sorted(name for name in table.columns if name not in (*ignore, PARTITION))
    # A null must not hash like nothing: its place counts.
    values = [F.coalesce(F.col(name).cast("string"), F.lit("\u0000")) for name in columns]
    hashed = F.xxhash64(*values)
    return table.groupBy(PARTITION).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hashed.cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(1), *values)).alias("mixed"),
        *also,
    )


def changed_seasons(
    spark: SparkSession, new: DataFrame, path: str, ignore: Collection[str] = ()
) -> tuple[list[int | None], list[int | None]]:
    """Seasons of ``new`` whose rows differ from those published at ``path``, and seasons published but not in ``new``.

    Columns in ``ignore`` do not count. One row a season comes to the driver.
    """
    if not path_exists(spark, path):
        return [row[PARTITION] for row in new.select(PARTITION).distinct().collect()], []
    before = {row[PARTITION]: row for row in season_digests(read_table(spark, path, schema=new.schema), ignore).collect()}
    after = {row[PARTITION]: row for row in season_digests(new, ignore).collect()}
    order = lambda season: (season is not None, season)
    changed = [season for season, row in after.items() if before.get(season) != row]
    return sorted(changed, key=order), sorted(before.keys() - after.keys(), key=order)


def write_seasons(
    spark: SparkSession, frame: DataFrame, path: str, changed: Sequence[int | None], gone: Sequence[int | None] = ()
) -> None:
    """Replace some seasons of a table by the frame's rows of them and drop others; the rest is not touched."""
    if changed:
        write_table(frame.filter(in_seasons(changed)), path, dynamic=True)
    delete_seasons(spark, path, gone)


def delete_seasons(spark: SparkSession, path: str, seasons: Collection[int | None]) -> None:
    """Drop some seasons of a table."""
    for season in seasons:
        delete_path(spark, join_path(path, f"{PARTITION}={_NULL_PARTITION if season is None else season}"))


def write_quarantine(violating: DataFrame, path: str, run_date: str) -> None:
    """Write violating rows under ``check_name=/run_date=``; checks without such rows are left as they are."""
    dated = violating.withColumn("run_date", F.lit(run_date))
    write_table(dated, path, ("check_name", "run_date"), gather=True, dynamic=True)
