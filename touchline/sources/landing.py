"""Landing of source files into the raw layer, with a manifest of what was landed.

Raw data is the lines of a file as they are: they are copied, not parsed, so no value, blank line or surplus column can
get lost or change. Only the header line is taken out, since a large file is landed in many parts; it is in the manifest,
from which the reader of the raw layer takes the columns. Text that is not UTF-8 is decoded as ISO-8859-1, which gives
every byte a character, and stored as UTF-8; the manifest names the encoding.

*The manifest is the commit.* Every landing of a file writes a folder of its own, named by a run; the file's manifest
record names that folder, and the reader of the raw layer takes exactly the folders that records name. A landing that
fails leaves the earlier rows; one that succeeds replaces them, also by none. Folders that records no longer name are
deleted afterwards, and ``drop_unnamed`` deletes those of failed landings.

*A record is a line*, whatever quotes it holds, unless the caller lists the source as one whose quoted values hold line
breaks. Then records are cut by quote parity: the quotes of every split are counted, the exclusive prefix sum over a
file's splits says in which of them a quoted value is open at the beginning, and each line continues a record if an odd
number of quotes stand before it. Only the pieces at the edges of splits meet once more, so large files are cut in
parallel.

*A digest needs a file's bytes in order*: the scan is planned with one split per file, whose lines stream through one
running hash, so a file of any size is digested in the memory of one batch.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.sources.lake import Lake
from touchline.sources.storage import (
    child_directories,
    delete_path,
    empty_files,
    join_path,
    largest_and_total,
    literal_path,
    path_exists,
    qualified,
    staging_path,
)

# Encodings tried, in order. A byte order mark is dropped.
PREFERRED_ENCODING, FALLBACK_ENCODING = "UTF-8", "ISO-8859-1"

FILE, PART, RUN = "file", "part", "run"

MANIFEST_SCHEMA = (
    "source string, load_date string, file string, part string, run string, source_name string, "
    "original_filename string, source_path string, lake_root string, raw_path string, metadata_path string, "
    "file_size_bytes bigint, row_count bigint, column_count int, columns array<string>, header string, "
    "spans_lines boolean, file_sha256 string, encoding string, ingested_at_utc string"
)

# One value of a header line with the comma before it: quoted, or plain.
_HEADER_VALUE = r'(?:^|,)(?:"(?:[^"]|"")*"|[^,]*)'
_BYTE_ORDER_MARK = b"\xef\xbb\xbf"
_DIGEST_BATCH = 8 << 20


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file_path")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file_path, block, value): lines between line feeds, byte for byte, and where their split begins."""
    read = spark.read.text(path, lineSep="\n", recursiveFileLookup=True)
    return read.select(_file(), F.col("_metadata.file_block_start").alias("block"), "value")


def _quotes(value: str) -> Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def _records_in(value: Column) -> Column:
    """Lines in a text that are not blank; a carriage return ends a line as well."""
    return F.size(F.filter(F.split(value, "\r"), lambda piece: F.trim(piece) != ""))


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file_path, records, first, broken_header, valid_utf8), one per file that has any line.

    ``records`` counts lines that are not blank, ``first`` is the first line in bytes, ``broken_header`` whether it has an
    odd number of quotes. Files are read in splits and combined map-side.
    """
    where = F.struct("block", F.monotonically_increasing_id().alias("i"))
    binary = F.col("value").cast("binary")
    lines = _lines(spark, path).select(
        "file_path",
        where.alias("at"),
        F.struct(binary.alias("first"), (_quotes("value") % 2 == 1).alias("broken_header")).alias("line"),
        F.is_valid_utf8(binary).alias("valid"),
        _records_in(F.col("value")).alias("records"),
    )
    return lines.groupBy("file_path").agg(
        F.sum("records").alias("records"), F.min_by("line", "at").alias("line"), F.bool_and("valid").alias("valid_utf8")
    ).select("file_path", "records", "line.first", "line.broken_header", "valid_utf8")


def spanning_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file_path, value, is_header): records whose quoted values may hold line breaks, cut in parallel."""
    lines = _lines(spark, path).select(
        "*", F.monotonically_increasing_id().alias("i"), (_quotes("value") % 2).alias("odd")
    )
    splits = lines.groupBy("file_path", "block").agg(F.sum("odd").alias("odd"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Some numbers a split of a file, not a line.
    open_at = splits.select("file_path", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("carried"))
    split = Window.partitionBy("file_path", "block").orderBy("i")
    above = split.rowsBetween(Window.unboundedPreceding, -1)
    told = lines.join(open_at, ["file_path", "block"]).withColumn(
        "begins", ((F.col("carried") + F.coalesce(F.sum("odd").over(above), F.lit(0))) % 2 == 0).cast("int")
    )
    numbered = told.withColumn("n", F.sum("begins").over(split))
    pieces = numbered.groupBy("file_path", "block", "n").agg(_joined("i", "value").alias("value"))
    # A record goes on in the next split only from the last piece of one to the piece before the first beginning.
    last = F.max("n").over(Window.partitionBy("file_path", "block"))
    marked = pieces.withColumn("at_edge", (F.col("n") == 0) | (F.col("n") == last))
    inner = marked.where("not at_edge")
    order = Window.partitionBy("file_path").orderBy("block", "n")
    edges = marked.where("at_edge").withColumn("record", F.sum((F.col("n") > 0).cast("int")).over(order))
    places = F.struct("block", "n")
    joined = edges.groupBy("file_path", "record").agg(
        F.min(places).alias("place"), _joined(places, "value").alias("value")
    )
    first = F.struct(F.lit(0).cast("long").alias("block"), F.lit(1).cast("long").alias("n"))
    return inner.select("file_path", "value", (places == first).alias("is_header")).unionByName(
        joined.select("file_path", "value", (F.col("place") == first).alias("is_header"))
    )


def _joined(order: Column | str, value: str) -> Column:
    """Texts of a group as one, in order, with line feeds between them."""
    rows = F.array_sort(F.collect_list(F.struct(order if isinstance(order, Column) else F.col(order), value)))
    return F.array_join(F.transform(rows, lambda row: row[value]), "\n")


@contextmanager
def _one_split_per_file(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Plan scans so that no file is cut: a split may be as large as the largest file, small files share one."""
    sizes = [largest_and_total(spark, path) for path in paths]
    split = max([_MIN_SPLIT, *(largest for largest, _ in sizes)]) + 1
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.files.minPartitionNum": str(max(1, min(total for _, total in sizes) // split)),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(_DIGEST_BATCH),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_MIN_SPLIT = 128 << 20


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each file from its lines in order, and how many later lines equal the first."""
    name, size, plain, marked, seen, first, again = None, 0, None, None, 0, None, 0

    def row() -> pa.RecordBatch:
        # Lines lack the last line feed if the file does, and the reader leaves out a byte order mark.
        rest = size - seen
        digest = (marked if rest >= 2 else plain).copy()
        if rest not in (-1, 0, 2, 3):
            raise ValueError(f"{name} was not read whole and in order: {seen} of {size} bytes")
        if rest in (0, 3):
            digest.update(b"\n")
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([digest.hexdigest()]), pa.array([again], pa.int64())],
            ["file_path", "sha256", "header_again"],
        )

    for batch in batches:
        names, sizes, values = batch.columns
        ends = pc.run_end_encode(names)
        start = 0
        for at, end in enumerate(ends.run_ends.to_pylist()):
            own, part = ends.values[at].as_py(), values.slice(start, end - start)
            if own != name:
                if name is not None:
                    yield row()
                name, size, seen, first, again = own, sizes[start].as_py(), 0, part[0], -1  # the first itself
                plain, marked = hashlib.sha256(), hashlib.sha256(_BYTE_ORDER_MARK)
            elif seen:
                plain.update(b"\n")
                marked.update(b"\n")
            again += pc.sum(pc.equal(part, first)).as_py()
            data = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], part), b"\n")[0].as_buffer()
            plain.update(data)
            marked.update(data)
            seen += len(data) + 1
            start = end
    if name is not None:
        yield row()


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows (file_path, length, sha256, header_again), one per file below some paths that has any byte; stored.

    Each file streams through one task; its task holds a batch of lines, whatever the file's size.
    """
    stage = staging_path(spark, uuid.uuid4().hex, "digests")
    with _one_split_per_file(spark, *paths):
        read = [spark.read.text(path, lineSep="\n", recursiveFileLookup=True) for path in paths]
        lines = [
            one.select(_file(), F.col("_metadata.file_size").alias("length"), F.col("value").cast("binary"))
            for one in read
        ]
        found = [
            one.mapInArrow(_stream_digests, "file_path string, sha256 string, header_again long") for one in lines
        ]
        reduce(DataFrame.unionByName, found).write.parquet(stage)
    return spark.read.schema("file_path string, sha256 string, header_again long").parquet(stage)


def _decoded(binary: Column, valid: Column) -> Column:
    return F.when(valid, F.decode(binary, PREFERRED_ENCODING)).otherwise(F.decode(binary, FALLBACK_ENCODING))


def _header_columns(header: Column) -> Column:
    """Names in a header line; quotes around a name are taken off."""
    values = F.transform(
        F.regexp_extract_all(header, F.lit(_HEADER_VALUE), F.lit(0)),
        lambda value, at: F.when(at > 0, F.substr(value, F.lit(2))).otherwise(value),
    )
    plain = lambda value: F.replace(F.substr(value, F.lit(2), F.length(value) - 2), F.lit('""'), F.lit('"'))
    return F.transform(values, lambda value: F.when(value.startswith('"'), plain(value)).otherwise(value))


def _relative(path: Column, base: str) -> Column:
    """A file's path below the folder it was found in; its name if it was named itself."""
    inside = re.escape(base.rstrip("/")) + "/+"
    return F.when(path.rlike("^" + inside), F.regexp_replace(path, "^" + inside, "")).otherwise(
        F.substring_index(path, "/", -1)
    )


def _file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file_path, length) from the file listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(path).select(_file(), "length")


def _facts(spark: SparkSession, path: str, spanning: bool) -> DataFrame:
    """One row per file: header, record count, place, size."""
    literal = literal_path(spark, path)
    facts = _file_sizes(spark, literal).join(file_lines(spark, literal), "file_path")
    if spanning:
        counted = spanning_records(spark, literal).groupBy("file_path").agg(
            # Read across lines, only a line without any character is no record.
            F.sum((~F.col("value").isin("", "\r")).cast("long")).alias("spanning"),
            F.max(F.when(F.col("is_header"), F.col("value"))).alias("head"),
        )
        facts = facts.join(counted, "file_path").select(
            "file_path", "length", F.col("spanning").alias("records"), F.col("head").cast("binary").alias("first"),
            F.rlike("head", F.lit(r"\r(?!\n|$)")).alias("broken_header"), "valid_utf8",
        )
    place = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    text = F.regexp_replace(_decoded(F.col("first"), F.col("valid_utf8")), "^﻿", "")
    # Line breaks are line feeds here; a carriage return ends the header line as well.
    header = F.rtrim(F.regexp_replace(text, "\r$", "")) if spanning else F.rtrim(F.substring_index(text, "\r", 1))
    return facts.select(
        "*",
        header.alias("header"),
        place.alias("source_path"),
        _relative(F.regexp_replace(place, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/"), qualified(spark, path)).alias(FILE),
        F.lit(spanning).alias("spans_lines"),
    )


def build_manifest(
    spark: SparkSession,
    lake: Lake,
    files: Mapping[str, str],
    now: datetime | None = None,
    spanning: Collection[str] = (),
) -> DataFrame:
    """One row per file of a catalogue {source: file, folder or glob path}; contents are read by tasks only.

    ``spanning`` names the sources whose quoted values may hold line breaks. For others a record is a line, and a header
    line in which a quote stays open is refused. Spanning records are cut at line feeds only, so files whose lines end with a
    carriage return alone are refused there.
    """
    for path in files.values():
        if not path_exists(spark, path):
            raise FileNotFoundError(f"source file not found: {path}")
    if empty := [name for path in files.values() for name in empty_files(spark, path)]:
        raise ValueError(f"no header in {empty}")
    now = now or datetime.now(timezone.utc)
    load_date, run = now.date().isoformat(), f"{now:%H%M%S}-{uuid.uuid4().hex[:12]}"
    found = reduce(
        DataFrame.unionByName,
        [_facts(spark, path, source in spanning).withColumn("source", F.lit(source)) for source, path in files.items()],
    )
    found = found.join(file_digests(spark, *(literal_path(spark, path) for path in files.values())).distinct(), "file_path")
    columns = _header_columns(F.col("header"))
    # Readable, free of characters that paths escape, and different for different files.
    part = F.concat(F.regexp_replace(FILE, "[^A-Za-z0-9._-]", "_"), F.lit("-"), F.left(F.md5(FILE), F.lit(8)))
    below = F.concat(F.lit("source="), "source", F.lit(f"/load_date={load_date}/{PART}="), part)
    return found.select(
        "source",
        F.lit(load_date).alias("load_date"),
        FILE,
        part.alias(PART),
        F.lit(run).alias(RUN),
        F.col("source").alias("source_name"),
        F.substring_index("source_path", "/", -1).alias("original_filename"),
        "source_path",
        F.lit(lake.root).alias("lake_root"),
        F.concat(F.lit(lake.raw_root() + "/"), below, F.lit(f"/{RUN}={run}")).alias("raw_path"),
        F.concat(F.lit(lake.manifest() + "/"), below).alias("metadata_path"),
        F.col("length").alias("file_size_bytes"),
        (F.col("records") - 1).alias("row_count"),
        F.size(columns).alias("column_count"),
        columns.alias("columns"),
        "header",
        "spans_lines",
        F.col("sha256").alias("file_sha256"),
        F.when(F.col("valid_utf8"), PREFERRED_ENCODING).otherwise(FALLBACK_ENCODING).alias("encoding"),
        F.lit(now.isoformat()).alias("ingested_at_utc"),
        "file_path",
        "first",
        "valid_utf8",
        "broken_header",
        "header_again",
    )


_WORKING = ("file_path", "first", "valid_utf8", "broken_header", "header_again")


def write_manifest(manifest: DataFrame, lake: Lake) -> None:
    """One JSON record per file, under ``source=/load_date=/part=``; other files' records stay."""
    (
        manifest.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "load_date", PART)
        .json(lake.manifest())
    )


def read_manifest(spark: SparkSession, lake: Lake, source: str, load_date: str) -> DataFrame:
    """The records of one load; empty if there are none."""
    path = lake.manifest_of(source, load_date)
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True)
    # Partition columns are not in the files.
    part = F.regexp_extract(F.col("_metadata.file_path"), f"/{PART}=([^/]*)/", 1)
    return reader.json(path).withColumns({"source": F.lit(source), "load_date": F.lit(load_date), PART: part})


def _raw_lines(spark: SparkSession, path: str, files: DataFrame, spanning: bool) -> DataFrame:
    """Rows (part, run, value): a source's records without the header of each file, as UTF-8."""
    literal = literal_path(spark, path)
    keys = files.select("file_path", PART, RUN, "first", "valid_utf8", "header_again")
    binary = F.col("value").cast("binary")
    decoded = _decoded(binary, F.col("valid_utf8")).alias("value")
    if spanning:
        return (
            spanning_records(spark, literal).where("not is_header").join(keys, "file_path").select(PART, RUN, decoded)
        )
    rows = _lines(spark, literal).join(keys, "file_path").where(binary != F.col("first")).select(PART, RUN, decoded)
    # Lines equal to the header are the same text, so they need not be read again: the digest's pass has counted them.
    header = _decoded(F.col("first"), F.col("valid_utf8"))
    again = keys.where("header_again > 0").withColumn("_", F.explode(F.expr("sequence(1, cast(header_again as int))")))
    # What a carriage return cuts from the header line.
    line = F.substring_index(header, "\r", 1)
    rest = F.regexp_replace(F.substr(header, F.length(line) + 2), "\n$", "")
    rests = keys.select(PART, RUN, rest.alias("value")).where("value <> ''")
    return rows.unionByName(again.select(PART, RUN, header.alias("value"))).unionByName(rests)


def land_files(
    spark: SparkSession,
    lake: Lake,
    files: Mapping[str, str],
    now: datetime | None = None,
    spanning: Collection[str] = (),
) -> DataFrame:
    """Land a catalogue {source: file, folder or glob path} under today's load date (UTC); returns its manifest.

    There is one folder per source file, keyed by its path below the given one, with as many parts as tasks read it.
    Landing a file again replaces it and leaves others. ``spanning`` is as in ``build_manifest``.
    """
    now = now or datetime.now(timezone.utc)
    load_date = now.date().isoformat()
    built = build_manifest(spark, lake, files, now, spanning)
    stage = staging_path(spark, lake.root, uuid.uuid4().hex, "manifest")
    built.write.parquet(stage)
    facts = spark.read.schema(built.schema).parquet(stage)
    if broken := facts.where("broken_header").select("source_path").limit(5).collect():
        raise ValueError(f"a quote stays open in the header line, or carriage returns end lines: {[row[0] for row in broken]}")
    landed = [
        _raw_lines(spark, path, facts.where(F.col("source") == source), source in spanning).withColumn("source", F.lit(source))
        for source, path in files.items()
    ]
    (
        reduce(DataFrame.unionByName, landed)
        .withColumn("load_date", F.lit(load_date))
        .write.mode("append")  # each run has folders of its own
        .option("lineSep", "\n")
        .partitionBy("source", "load_date", PART, RUN)
        .text(lake.raw_root())
    )
    replaced = _folders(spark, lake, files, load_date, facts.select("source", PART))
    manifest = facts.drop(*_WORKING)
    write_manifest(manifest, lake)
    for folder in replaced:
        delete_path(spark, folder)
    return manifest


def _folders(
    spark: SparkSession, lake: Lake, sources: Collection[str], load_date: str, parts: DataFrame
) -> list[str]:
    """Folders that the present records of some parts name: one path a file."""
    records = [read_manifest(spark, lake, source, load_date).select("source", PART, "raw_path") for source in sources]
    return [row["raw_path"] for row in reduce(DataFrame.unionByName, records).join(parts, ["source", PART]).collect()]


def drop_unnamed(spark: SparkSession, lake: Lake, source: str, load_date: str) -> list[str]:
    """Delete the folders of a load that no manifest record names, left by landings that failed; none may be running."""
    named = {row["raw_path"] for row in read_manifest(spark, lake, source, load_date).select("raw_path").collect()}
    load, dropped = lake.raw_load(source, load_date), []
    for part in child_directories(spark, load):
        for run in child_directories(spark, join_path(load, part)):
            folder = join_path(load, part, run)
            if folder not in named:
                delete_path(spark, folder)
                dropped.append(folder)
    return dropped


def with_file_digest(frame: DataFrame, manifest: DataFrame, column: str = "source_file") -> DataFrame:
    """Add ``file_sha256`` of the landed file that a row came from, whose part ``column`` names."""
    below = "(source=[^/]*/load_date=.*)"
    names = manifest.select(
        F.regexp_extract("raw_path", below, 1).alias("_folder"), F.col("file_sha256")
    )
    keyed = frame.withColumn("_folder", F.regexp_extract(column, below + "/[^/]*$", 1))
    return keyed.join(names, "_folder", "left").drop("_folder")
