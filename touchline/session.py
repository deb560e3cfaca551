"""Session defaults for running the pipeline. Any setting can be overridden by the caller or the cluster."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # The JVM never compiles a method above 8000 bytecodes. A wide projection that fuses into one is better run
    # as separate compiled expressions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Start (or get) a session; keyword names use ``__`` where the Spark key has a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Each action inside deletes its shuffle files when it ends. Otherwise they stay until the driver happens to collect
# garbage, so that those of several steps lie on the disks at once. No frame may be run twice there: its second run would
# find its shuffle files gone and make them again.
SWEPT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def swept_session(spark: SparkSession, **more: str) -> Iterator[SparkSession]:
    """Shuffle files go with their action for the work done inside, in a session started elsewhere; then all as it was.

    ``more`` are other settings for that time; their names use ``__`` where the Spark key has a dot.
    """
    wanted = SWEPT | {key.replace("__", "."): value for key, value in more.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def tuned_session(spark: SparkSession) -> Iterator[SparkSession]:
    """The code-generation limit, and swept shuffle files, for the work done inside."""
    with swept_session(spark, spark__sql__codegen__hugeMethodLimit=DEFAULTS["spark.sql.codegen.hugeMethodLimit"]):
        yield spark


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
BYTES_PER_PARTITION = 128 << 20
# Each map task writes a block for each reducer, so both must grow slower than the input. Up to LINEAR_PARTITIONS
# reducers their number follows the input; beyond, its square root, and so does the size of scan splits.
LINEAR_PARTITIONS = 4_000
LARGEST_SPLIT = 1 << 30


def shuffle_plan(input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION) -> tuple[int, int]:
    """The number of reducers and the bytes of a scan split for an input.

    100 TB give some 57,000 reducers of about 1.8 GB and some 100,000 scan tasks of 1 GB.
    """
    wanted = math.ceil(input_bytes / bytes_per_partition)
    if wanted <= LINEAR_PARTITIONS:
        return wanted, bytes_per_partition
    growth = math.sqrt(wanted / LINEAR_PARTITIONS)
    return math.ceil(LINEAR_PARTITIONS * growth), min(LARGEST_SPLIT, int(bytes_per_partition * growth))


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[int]:
    """Raise the number of shuffle partitions and the size of scan splits to fit an input, for the work done inside.

    Adaptive execution merges partitions that turn out small but does not add any, so a default of 200 would
    put hundreds of gigabytes of a large load into each task.
    """
    before = {key: spark.conf.get(key) for key in (SHUFFLE_PARTITIONS, SCAN_BYTES)}
    reducers, split = shuffle_plan(input_bytes, bytes_per_partition)
    partitions = max(int(before[SHUFFLE_PARTITIONS]), reducers)
    spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
    if split > bytes_per_partition:
        spark.conf.set(SCAN_BYTES, str(split))
    try:
        yield partitions
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
