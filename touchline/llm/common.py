"""Helpers shared by the operators of this subpackage: input tables, intermediate tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from touchline.sources.storage import join_path, shared_folder

#: What separates words in every contract of this subpackage: space, tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of text one step of a task holds as Python objects.
BLOCK_BYTES = 8 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that driver and executors share."""
    return join_path(shared_folder(spark), "touchline-llm", f"{name}-{uuid.uuid4().hex}")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BLOCK_BYTES`` at most from now on, since several copies of a batch are in memory at once.

    For frames that run after they are returned, so the setting stays.
    """
    spark.conf.set(_BATCH_BYTES, str(BLOCK_BYTES))


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and read it back: cuts lineage, and survives the loss of executors."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH_BYTES)
    small_batches(spark)
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(frame.schema).parquet(path)


def drop_staged(frame: DataFrame) -> None:
    """Delete the files of a table made by ``staged``, once nothing reads it any more."""
    spark = frame.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        if "/touchline-llm/" in folder:
            located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(located, True)


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        size = max(1, batch.column(batch.schema.get_field_index(text)).nbytes)
        rows = max(1, min(batch.num_rows, batch.num_rows * limit // size))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [value or "" for value in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def map_blocks(
    frame: DataFrame,
    text: str,
    schema: str,
    process: Callable[[pa.RecordBatch], dict[str, list]],
    row: str | None = None,
) -> DataFrame:
    """Apply ``process`` to blocks of rows in Arrow; it returns the output columns by name.

    ``row`` names a column to add that numbers the rows, each once. A second run may number them otherwise, so the
    result must be stored before the numbers are used.
    """
    schema = f"{schema}, `{row}` long" if row else schema
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for block in blocks(batches, text):
            columns = process(block)
            if row:
                columns[row] = range(number, number + block.num_rows)
                number += block.num_rows
            yield pa.RecordBatch.from_arrays(
                [_array(columns[field.name], field.type) for field in target], schema=target
            )
            pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def ddl(frame: DataFrame, *columns: str) -> str:
    """The schema of some columns as text."""
    types = {field.name: field.dataType.simpleString() for field in frame.schema.fields}
    return ", ".join(f"`{name}` {types[name]}" for name in columns or frame.columns)
