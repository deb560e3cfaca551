"""SimHash near-duplicates: fingerprints of word shingles, linked at a small Hamming distance by pigeonring chains.

A fingerprint is cut into ``SEGMENTS`` segments on a ring. If two fingerprints differ in at most ``DISTANCE`` bits,
there is a segment from which every chain of l consecutive segments differs in at most l * DISTANCE / SEGMENTS bits,
rounded down: 0 in the first segment, 1 in two, 2 in three, and so on. Candidates are found by the first three: the
first is equal; then either the second is equal and one third of the third one, or a half of each is equal. That
gives seven exact keys of 26 bits or more for each start. In a bucket of one key, pairs that break a chain's budget
are pruned; the last chain, the whole ring, is the Hamming check.

Equal fingerprints are one vertex. A bucket reports a spanning forest of its links, not all pairs: vertices reached
are not compared again. Buckets over ``BUCKET_ROWS`` vertices are cut into chunks, and every two chunks become one
group of a second pass. So no task holds a bucket and no link is lost.

Null and empty texts, and texts without words, have fingerprint zero. Texts with fewer words than a shingle hash their
whole word sequence. Rows that repeat are rows of one component. Null keys come last: a component's id is null only if
all its keys are. Extra columns, whatever their names, are left out unless they are kept. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ddl, map_blocks, staged, texts_of
from touchline.llm.components import connected_components

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
SEGMENTS = 5
BITS = 64
#: Vertices of one bucket that a task compares at once.
BUCKET_ROWS = 200_000
#: Groups up to this size are compared in vectors over many groups.
SMALL_GROUP = 8
#: Shingles hashed before their bits are added up.
_CHUNK = 1 << 16

_EDGES = [BITS * number // SEGMENTS for number in range(SEGMENTS + 1)]


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a text."""
    words = text.encode().lower().split()  # of bytes: lowers A-Z only, splits at space and tab to carriage return
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[start:end], SEED) for start, end in spans]), np.uint8)
        ones += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, a number for each row (``_row``) and the fingerprint as a signed number (``_fp``)."""

    def process(block: pa.RecordBatch) -> dict[str, list]:
        prints = np.array([fingerprint(value) for value in texts_of(block, text)], np.uint64)
        columns = {name: block.column(block.schema.get_field_index(name)) for name in keep}
        return columns | {"_fp": prints.view(np.int64)}

    schema = f"{ddl(docs, *keep)}, _fp long"
    return map_blocks(docs.select(*dict.fromkeys([*keep, text])), text, schema, process, row="_row")


def _bits(start: int, end: int) -> Column:
    return F.shiftrightunsigned("_fp", BITS - end).bitwiseAND((1 << (end - start)) - 1)


def _cuts(segment: int, parts: int) -> list[tuple[int, int]]:
    """A segment's parts as ranges of bits."""
    start, end = _EDGES[segment % SEGMENTS], _EDGES[segment % SEGMENTS + 1]
    marks = [start + (end - start) * number // parts for number in range(parts + 1)]
    return list(zip(marks[:-1], marks[1:], strict=True))


def key_ranges() -> list[tuple[int, list[tuple[int, int]]]]:
    """For each key: the segment its chain starts from, and the ranges of bits that make it."""
    keys = []
    for start in range(SEGMENTS):
        whole = _cuts(start, 1)
        keys += [(start, whole + _cuts(start + 1, 1) + [third]) for third in _cuts(start + 2, 3)]
        keys += [
            (start, [*whole, second, third]) for second in _cuts(start + 1, 2) for third in _cuts(start + 2, 2)
        ]
    return keys


#: A bucket's number holds the key's number above these bits, and the key's bits below.
_KEY_SHIFT = 40


def _buckets() -> Column:
    """The numbers of the buckets that a fingerprint is in."""
    numbers = []
    for key, (_, ranges) in enumerate(key_ranges()):
        bits = F.lit(0).cast("long")
        for start, end in ranges:
            bits = F.shiftleft(bits, end - start).bitwiseOR(_bits(start, end))
        numbers.append(bits.bitwiseOR(key << _KEY_SHIFT))
    return F.array(*numbers)


def _chain_masks() -> np.ndarray:
    """For each start and chain length: the bits of that chain."""
    segment = [((1 << (b - a)) - 1) << (BITS - b) for a, b in zip(_EDGES[:-1], _EDGES[1:], strict=True)]
    masks = np.zeros((SEGMENTS, SEGMENTS), np.uint64)
    for start in range(SEGMENTS):
        chain = 0
        for length in range(SEGMENTS):
            chain |= segment[(start + length) % SEGMENTS]
            masks[start, length] = chain
    return masks


_MASKS = _chain_masks()
_BUDGETS = [(length + 1) * DISTANCE // SEGMENTS for length in range(SEGMENTS)]
_STARTS = np.array([start for start, _ in key_ranges()])


def _near(differences: np.ndarray, starts: np.ndarray | int) -> np.ndarray:
    """Which differences keep the budget of every chain from their start; the last chain is the whole ring."""
    near = np.ones(len(differences), bool)
    for length, budget in enumerate(_BUDGETS):
        near &= np.bitwise_count(differences & _MASKS[starts, length]) <= budget
    return near


def _links(buckets: np.ndarray, groups: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of rows that stand together: all pairs of small groups, a spanning forest of large ones."""
    size = len(groups)
    first = np.ones(size, bool)
    first[1:] = (groups[1:] != groups[:-1]) | (buckets[1:] != buckets[:-1])
    group = np.cumsum(first)
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, size))
    chains = _STARTS[buckets >> _KEY_SHIFT]
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    here = np.flatnonzero(np.repeat(sizes <= SMALL_GROUP, sizes))
    for step in range(1, SMALL_GROUP):
        here = here[here + step < size]
        here = here[group[here] == group[here + step]]
        near = here[_near(prints[here] ^ prints[here + step], chains[here])]
        left.append(prints[near])
        right.append(prints[near + step])
    large = sizes > SMALL_GROUP
    for start, count in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
        own, chain = prints[start : start + count], int(chains[start])
        apart = np.arange(count)
        while len(apart):
            reached, apart = [apart[0]], apart[1:]
            while reached and len(apart):
                vertex = own[reached.pop()]
                near = _near(own[apart] ^ vertex, chain)
                found = apart[near]
                left.append(np.full(len(found), vertex))
                right.append(own[found])
                reached.extend(found.tolist())
                apart = apart[~near]
    return np.concatenate(left), np.concatenate(right)


_FOUND = "u long, v long, _bucket long, _fp long, _chunk int"


def _found(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Links as rows of the result."""
    none = [pa.nulls(len(u), kind) for kind in (pa.int64(), pa.int64(), pa.int32())]
    columns = [pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), *none]
    return pa.RecordBatch.from_arrays(columns, ["u", "v", "_bucket", "_fp", "_chunk"])


def _put_off(buckets: np.ndarray, prints: np.ndarray, chunk: int) -> pa.RecordBatch:
    """Rows of a bucket that is too large, with the number of their chunk."""
    none = pa.nulls(len(prints), pa.int64())
    chunks = pa.array(np.full(len(prints), chunk, np.int32))
    columns = [none, none, pa.array(buckets), pa.array(prints.view(np.int64)), chunks]
    return pa.RecordBatch.from_arrays(columns, ["u", "v", "_bucket", "_fp", "_chunk"])


def _link_sorted(limit: int | None):
    """Links of rows sorted by group. A group over ``limit`` rows comes out again in chunks of about that size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        cut_group, chunk = None, 0

        def ended(buckets: np.ndarray, prints: np.ndarray, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Rows whose groups have ended; the first may be the rest of a group that was cut."""
            rest = int(np.searchsorted(groups != cut_group, True)) if cut_group is not None else 0
            if rest:
                yield _put_off(buckets[:rest], prints[:rest], chunk)
            if rest < len(groups):
                yield _found(*_links(buckets[rest:], groups[rest:], prints[rest:]))

        for batch in batches:
            bucket, fp, group = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            held = [np.concatenate(pair) for pair in zip(held, (bucket, fp.view(np.uint64), group), strict=True)]
            if not len(held[2]):
                continue
            last = int(np.searchsorted(held[2], held[2][-1]))
            if last:
                yield from ended(*[column[:last] for column in held])
                held = [column[last:] for column in held]
            if cut_group is not None and cut_group != held[2][0]:
                cut_group, chunk = None, 0
            if limit is not None and len(held[2]) >= limit:
                yield _put_off(held[0], held[1], chunk)
                cut_group, chunk = held[2][0], chunk + 1
                held = [column[:0] for column in held]
        yield from ended(*held)

    return run


def links(vertices: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``u``, ``v`` between fingerprints (``_fp``, each once) that connect all within the distance."""
    rows = vertices.select(F.explode(_buckets()).alias("_bucket"), "_fp").withColumn("_group", F.col("_bucket"))
    rows = rows.repartition("_group").sortWithinPartitions("_group")
    first = staged(rows.mapInArrow(_link_sorted(bucket_rows), _FOUND), "links")
    chunks = first.where("_fp is not null").select("_bucket", "_fp", "_chunk")
    last = chunks.groupBy("_bucket").agg(F.max("_chunk").alias("_last"))
    pairs = chunks.join(last, "_bucket").withColumn("_other", F.explode(F.sequence(F.lit(0), "_last")))
    # Should two pairs of chunks share a number, their rows still stand apart by bucket or are compared once more.
    group = F.xxhash64("_bucket", F.least("_chunk", "_other"), F.greatest("_chunk", "_other")).alias("_group")
    grouped = pairs.select("_bucket", "_fp", group).repartition("_group").sortWithinPartitions("_group", "_bucket")
    second = grouped.mapInArrow(_link_sorted(None), _FOUND)
    return first.where("u is not null").select("u", "v").unionByName(second.select("u", "v"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (the key by default) of every row, with

    * ``fingerprint``: 16 hexadecimal digits,
    * ``component_id``: the smallest key that links reach from the row,
    * ``kept``: true for one row of each component, one with that key.
    """
    keep = list(dict.fromkeys([key, *(keep or [])]))
    rows = staged(with_fingerprints(docs, text, keep), "fingerprints")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row"))
    vertices = staged(rows.groupBy("_fp").agg(F.min(order).alias("_first")), "vertices")
    roots = connected_components(links(vertices))
    linked = vertices.join(roots.withColumnRenamed("vertex", "_fp"), "_fp", "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
    )
    firsts = linked.groupBy("_root").agg(F.min("_first").alias("_least"))
    component = linked.join(firsts, "_root").select("_fp", "_least")
    return rows.join(component, "_fp").select(
        *keep,
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_least.key").alias("component_id"),
        (F.col("_row") == F.col("_least.row")).alias("kept"),
    )
