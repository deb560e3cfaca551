"""Exact deduplication by an extendible-hash index on shared files.

1. Key sizes. Each text has a 64-bit hash. Bytes per key prefix are summed and give the *directory*: it starts with one
   bucket; a bucket over its capacity splits, doubling the directory where needed, until every bucket fits or holds a
   single key. Only sums for prefixes of buckets that are still too full come to the driver.
2. Pages. Every task groups its rows by text, block by block. The row with the largest id of each group is the group's
   *entry* and keeps the text; the other rows only name their entry. Pages are written to the shared storage. So a text
   with a billion copies is shuffled once per block, not once per copy.
3. Owners. The directory deals key ranges to owner tasks. An owner reads its entries in key order, chains the different
   texts of one key and compares bytes. It holds the texts of one key at a time, which are one but for collisions.
   A key with more than ``MOST_ENTRIES`` entries, a text copied into very many blocks, is compared in two rounds: first
   in groups of about that many entries, dealt by row; then the entry that stays of each group stands for its group.
4. Classes. For each entry the owner writes the row that stays and the size of its class; rows find theirs by entry.

Null counts as empty, so null and empty texts are equal. Of equal texts the row with the largest id stays; a null id is
the smallest; of rows with equal ids one stays, no matter which, and the others are dropped. An empty table gives an
empty result. Columns beside key and text, whatever their names, are left out; some can be carried, but none that is
named like a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from touchline.llm.common import ddl, map_blocks, staged, texts_of

#: Bytes of text that a bucket holds before it splits.
CAPACITY = 16 << 20
#: Neighbouring buckets share an owner beyond so many owners: every task of the shuffle writes to each.
MOST_OWNERS = 20_000
#: Bits of the prefixes that the first sums are for, and of each further step for buckets still too full.
FIRST_BITS, STEP_BITS = 12, 6
#: The directory never has more than 2 ** MAX_BITS slots (some 16 bytes each). A bucket at this depth stays as it is.
MAX_BITS = 20
#: Entries of one key that one task compares; more are compared in groups of about so many first.
MOST_ENTRIES = 4096
#: Bytes an entry costs beside its text.
_ROW_BYTES = 64


class Directory:
    """Buckets by key prefix. Splitting a bucket of the directory's own depth doubles the directory."""

    def __init__(self):
        self.depth = 0
        self.slots = [0]
        self.prefixes = [(0, 0)]  # of each bucket: its depth and the bits that its keys begin with

    def split(self, bucket: int) -> tuple[int, int]:
        """Deal a bucket's keys to two by their next bit."""
        depth, prefix = self.prefixes[bucket]
        if depth == self.depth:
            self.slots = [number for number in self.slots for _ in range(2)]
            self.depth += 1
        new = len(self.prefixes)
        self.prefixes[bucket] = (depth + 1, prefix << 1)
        self.prefixes.append((depth + 1, prefix << 1 | 1))
        width = self.depth - depth - 1
        first = (prefix << 1 | 1) << width
        self.slots[first : first + (1 << width)] = [new] * (1 << width)
        return bucket, new

    def owners(self, loads: list[int], size: int) -> list[int]:
        """For each slot, its owner: neighbouring buckets up to ``size`` bytes share one."""
        owner, filled, number, of_bucket = 0, 0, {}, []
        for bucket in self.slots:
            if bucket not in number:
                if filled and filled + loads[bucket] > size:
                    owner, filled = owner + 1, 0
                filled += loads[bucket]
                number[bucket] = owner
            of_bucket.append(number[bucket])
        return of_bucket


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("_hash", 64 - bits)


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[Directory, list[int]]:
    """A directory for keys (``_hash``, each once, with ``_bytes``) and the bytes of each bucket."""
    directory, loads, bits = Directory(), [0], 0
    full = [0]
    while full and bits < MAX_BITS:
        known, bits = bits, min(MAX_BITS, bits + (STEP_BITS if bits else FIRST_BITS))
        wanted = keys
        if known:
            prefixes = [(directory.prefixes[bucket][1],) for bucket in full]
            schema = StructType([StructField("_part", LongType())])
            few = keys.sparkSession.createDataFrame(prefixes, schema)  # buckets that are too full: bytes / capacity
            wanted = keys.withColumn("_part", _prefix(known)).join(F.broadcast(few), "_part", "left_semi")
        sums = wanted.groupBy(_prefix(bits).alias("prefix")).agg(F.sum("_bytes").alias("b"), F.count("*").alias("n"))
        size, count = {}, {}
        for prefix, total, number in sums.collect():
            size[prefix], count[prefix] = total, number
        if not known:
            loads = [sum(size.values())]
            full = [0] if loads[0] > capacity else []
        below: dict[int, dict[int, tuple[int, int]]] = {}
        for prefix, total in size.items():
            for depth in range(known, bits + 1):
                level = below.setdefault(depth, {})
                old = level.get(prefix >> (bits - depth), (0, 0))
                level[prefix >> (bits - depth)] = (old[0] + total, old[1] + count[prefix])
        todo, full = full, []
        while todo:
            bucket = todo.pop()
            depth, prefix = directory.prefixes[bucket]
            loads[bucket], number = below.get(depth, {}).get(prefix, (0, 0))
            if loads[bucket] <= capacity or number <= 1:
                continue
            if depth == bits:
                full.append(bucket)
                continue
            pair = directory.split(bucket)
            loads.append(0)
            todo += pair
    return directory, loads


def _pages(docs: DataFrame, key: str, text: str, carry: list[str]) -> DataFrame:
    """All rows with their hash, SHA-256 and entry; the text and the number of rows at entries only."""
    columns = list(dict.fromkeys([key, *carry]))

    def process(block: pa.RecordBatch) -> dict[str, list]:
        texts = texts_of(block, text)
        ids = block.column(block.schema.get_field_index(key)).to_pylist()
        members: dict[str, list[int]] = {}
        for row, value in enumerate(texts):
            members.setdefault(value, []).append(row)
        hashes, digests, offset = [0] * len(texts), [""] * len(texts), [0] * len(texts)
        number: list[int | None] = [None] * len(texts)
        for value, rows in members.items():
            data = value.encode()
            hashed, digest = xxhash.xxh64_intdigest(data, 42), hashlib.sha256(data).hexdigest()
            best = max(rows, key=lambda row: _rank(ids[row]))
            number[best] = len(rows)
            for row in rows:
                hashes[row], digests[row], offset[row] = hashed, digest, best - row
        return {name: block.column(block.schema.get_field_index(name)) for name in columns} | {
            "_hash": np.array(hashes, np.uint64).view(np.int64),
            "_sha256": digests,
            "_offset": offset,
            "_rows": number,
            "_text": [value if rows else None for value, rows in zip(texts, number, strict=True)],
        }

    schema = f"{ddl(docs, *columns)}, _hash long, _sha256 string, _offset long, _rows long, _text string"
    wanted = list(dict.fromkeys([*columns, text]))
    return map_blocks(docs.select(*wanted), text, schema, process, row="_row").withColumn(
        "_entry", F.col("_row") + F.col("_offset")
    )


def _rank(value) -> tuple:
    """Order of ids: null is the smallest."""
    return (value is not None, value if value is not None else 0)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of entries in key order: a chain of different texts for each key, compared by bytes."""
    key, chain = None, []
    found: list[tuple] = []

    def close() -> None:
        for _, members in chain:
            best = max(members, key=lambda member: (_rank(member[1]), member[0]))
            size = sum(member[2] for member in members)
            found.extend((member[0], best[1], best[0], size) for member in members)

    def rows(kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        kinds = [pa.int64(), kind, pa.int64(), pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["_entry", "_keep", "_keep_row", "_size"])

    kind = pa.int64()
    for batch in batches:
        hashes, ids, numbers, counts, texts = batch.columns
        kind = ids.type
        for hashed, own, number, count, text in zip(
            hashes.to_pylist(), ids.to_pylist(), numbers.to_pylist(), counts.to_pylist(), texts, strict=True
        ):
            if hashed != key:
                close()
                key, chain = hashed, []
            value = text.as_buffer()
            for known, members in chain:
                if known.equals(value):
                    members.append((number, own, count))
                    break
            else:
                chain.append((value, [(number, own, count)]))
        if found:
            yield rows(kind)
            found = []
    close()
    if found:
        yield rows(kind)


def _compared(entries: DataFrame, id_type: str) -> DataFrame:
    """Classes of entries that are dealt and sorted by ``_hash``."""
    dealt = entries.select("_hash", "_id", "_row", "_rows", "_text")
    return dealt.mapInArrow(_compare, f"_entry long, _keep {id_type}, _keep_row long, _size long")


def _compare_crowded(entries: DataFrame, id_type: str, most_entries: int) -> tuple[DataFrame, DataFrame | None]:
    """Entries for the owners, and for those of crowded keys the entry that stands for each; None if no key is crowded.

    The crowded keys are stored first, so that their size is known when they are joined: few are broadcast, and the texts
    of the other entries stay where they are.
    """
    counts = entries.groupBy("_hash").agg(F.count("*").alias("_entries")).where(F.col("_entries") > most_entries)
    crowded = staged(counts, "crowded")
    if crowded.isEmpty():
        return entries, None
    groups = F.ceil(F.col("_entries") / most_entries)
    group = F.pmod(F.xxhash64("_row"), groups)
    dealt = entries.join(crowded, "_hash").withColumn("_hash", F.xxhash64("_hash", group))
    first = staged(_compared(dealt.repartition("_hash").sortWithinPartitions("_hash"), id_type), "crowded-classes")
    standing = first.where("_entry = _keep_row").select(F.col("_entry").alias("_row"), F.col("_size").alias("_rows"))
    rest = entries.join(crowded, "_hash", "left_anti")
    stand = entries.join(crowded, "_hash", "left_semi").drop("_rows").join(standing, "_row").select(entries.columns)
    return rest.unionByName(stand), first.select("_entry", F.col("_keep_row").alias("_standing"))


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    capacity: int = CAPACITY,
    most_entries: int = MOST_ENTRIES,
) -> DataFrame:
    """For each row: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``; with ``carry``, the named columns
    and ``_text`` too, which is null for rows that can not stay."""
    carry = [name for name in carry or [] if name not in (key, text)]
    hashed = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).select(
        F.xxhash64("_text").alias("_hash"), (F.octet_length("_text") + F.lit(_ROW_BYTES)).cast("long").alias("_bytes")
    )
    keys = staged(hashed.groupBy("_hash").agg(F.max("_bytes").alias("_bytes")), "keys")
    directory, loads = build_directory(keys, capacity)
    pages = staged(_pages(docs, key, text, carry), "pages")
    spark = docs.sparkSession
    owners = directory.owners(loads, max(capacity, sum(loads) // MOST_OWNERS))
    entries = pages.where("_rows is not null").select("_hash", F.col(key).alias("_id"), "_row", "_rows", "_text")
    id_type = dict(docs.dtypes)[key]
    entries, standing = _compare_crowded(entries, id_type, most_entries)
    slots = spark.createDataFrame(
        list(enumerate(owners)), StructType([StructField("_slot", LongType()), StructField("_owner", IntegerType())])
    )
    slot = _prefix(directory.depth) if directory.depth else F.lit(0).cast("long")
    owned = (
        entries.withColumn("_slot", slot)
        .join(F.broadcast(slots), "_slot")  # at most 2 ** MAX_BITS slots
        .repartitionById(max(owners) + 1, "_owner")
        .sortWithinPartitions("_hash")
    )
    classes = staged(_compared(owned, id_type), "classes")
    if standing is not None:
        of_standing = classes.withColumnRenamed("_entry", "_standing")
        plain = classes.join(standing, "_entry", "left_anti")
        classes = plain.unionByName(standing.join(of_standing, "_standing").select(classes.columns))
    return pages.join(classes, "_entry").select(
        key,
        *carry,
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.col("_sha256").alias("text_sha256"),
        *(["_text"] if carry else []),
    )
