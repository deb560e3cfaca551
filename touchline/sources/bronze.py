"""Raw CSV loads, laid out as ``source=<name>/load_date=<yyyy-MM-dd>/``."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from touchline.operators.guards import require_rows
from touchline.operators.loads import LOAD_DATE, choose_load_date
from touchline.sources.lake import Lake
from touchline.sources.storage import child_directories, literal_path, path_exists

SOURCE_FILE = "_source_file"
# Fixed value: how a path names its load date.
LOAD_DATE_PATTERN = r"load_date=(\d{4}-\d{2}-\d{2})"


def load_date_of(path: Column) -> Column:
    """Load date named in a file path, as text; empty if there is none."""
    return F.regexp_extract(path, LOAD_DATE_PATTERN, 1)


def read_csv_text(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, one record per line, every column as text.

    Columns match by position, so files that disagree on the header are refused rather than mixed up.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", False)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("encoding", encoding)
        .csv(path)
    )


def _read_landed(spark: SparkSession, lake: Lake, source: str, load_date: str) -> DataFrame:
    """Landed lines of exactly the folders that the manifest names, under the header that all files of the load have."""
    records = spark.read.schema("columns array<string>, spans_lines boolean, raw_path string, row_count bigint").option(
        "recursiveFileLookup", True
    )
    landed = records.json(lake.manifest_of(source, load_date)).collect()  # one record a file
    least, most = min(row["columns"] for row in landed), max(row["columns"] for row in landed)
    if least != most:
        raise ValueError(f"files of source {source}, load date {load_date} disagree on the header: {least}, {most}")
    times = Counter(name.lower() for name in least)
    names = [f"_c{at}" if not name else f"{name}{at}" if times[name.lower()] > 1 else name for at, name in enumerate(least)]
    schema = StructType([StructField(name, StringType()) for name in names])
    parts: list[DataFrame] = []
    for spans in (False, True):
        folders = [row["raw_path"] for row in landed if row["spans_lines"] == spans and row["row_count"] > 0]
        if folders:
            reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("multiLine", spans)
            parts.append(with_lineage(reader.csv([literal_path(spark, folder) for folder in folders])))
    if not parts:
        raise ValueError(f"no rows in source {source}, load date {load_date}")
    return reduce(DataFrame.unionByName, parts)


def with_lineage(frame: DataFrame) -> DataFrame:
    """Add the input file and the load date its path names, for a frame read straight from files."""
    path = F.col("_metadata.file_path")
    return frame.select("*", path.alias(SOURCE_FILE), load_date_of(path).alias(LOAD_DATE))


def load_dates(spark: SparkSession, lake: Lake, source: str) -> list[str]:
    # A load without any row has a manifest, but no raw folder.
    names = {
        *child_directories(spark, lake.raw_source(source)),
        *child_directories(spark, lake.manifest_source(source)),
    }
    found = (re.fullmatch(LOAD_DATE_PATTERN, name) for name in names)
    return sorted(match.group(1) for match in found if match)


def latest_load(spark: SparkSession, lake: Lake, source: str, load_date: str | None = None) -> str:
    """The given load date if the source has it, else its latest."""
    dates = load_dates(spark, lake, source)
    if not dates:
        raise ValueError(f"no files for source {source}")
    return choose_load_date(dates, load_date)


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    source: str,
    load_date: str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """One load of a source: the given one, else the latest.

    The load is chosen from directory names and only its directory is read, so older loads cost nothing and
    a different column order in one of them cannot mix up this one. If the load was landed with a manifest, the folders
    it names are read, whose lines have no header, under the manifest's columns; otherwise each file has its header.
    """
    chosen = latest_load(spark, lake, source, load_date)
    if path_exists(spark, lake.manifest_of(source, chosen)):
        raw = _read_landed(spark, lake, source, chosen)
    else:
        raw = with_lineage(read_csv_text(spark, lake.raw_load(source, chosen), encoding))
    return require_rows(raw, f"source {source}, load date {chosen}")
