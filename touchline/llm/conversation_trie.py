"""Prefix trie of conversations: ternary search trees per range shard, whose boundary nodes are merged.

1. *Turn ids.* A turn (role, text) becomes a record of ``RECORD`` bytes: the SHA-256 of both and the code points of the
   text. From here on no text is moved. A conversation is the sequence of its records, one binary value, so byte order
   of sequences is the order of a walk through the trie: what begins alike lies together.
2. *Range shards.* Different sequences are counted (combined map-side, so a thousand copies are one row) and ordered over
   ranges of their first ``KEY_TURNS`` turns. Each task streams its range in order and cuts it into shards of some
   ``SHARD_TURNS`` turns.
3. *Trees.* A shard numbers its different turns (the dictionary, in byte order) and inserts its sequences into a ternary
   search tree, the median first, so that the tree of siblings is balanced. Nodes come after their parents, so one
   loop back over them accumulates members, smallest member, children, leaves and savings; one loop forward gives the
   ids: a node's id is the SHA-256 of its parent's id and its record.
4. *Boundary nodes.* Only nodes on the way to a shard's first or last sequence can be in other shards too. All figures
   are sums, but for what neighbouring shards share: nodes on the common beginning of one's last and the next one's
   first sequence are counted twice as children and in savings, and a last sequence that the next one begins with is
   no leaf. *Junctions* between neighbours correct that, so one aggregate by id merges all boundary nodes.
5. *Ends.* Member ids of equal sequences are ordered over ranges of (sequence, id), packed into pieces of text, and
   hashed piece by piece in a stream.

A task holds one shard and one conversation's records (``RECORD`` bytes a turn), whatever group it belongs to.

Null roles and texts count as empty. Turns with equal numbers are in order of role, then digest; a null number comes
first. Repeated rows are turns of their own. A null conversation id is a conversation: it counts as member, but has no
number to be the smallest or to be listed by. Extra columns are ignored. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from touchline.llm.common import drop_staged, staged

#: Bytes of a turn's record: digest and, big-endian, code points.
DIGEST, RECORD = 32, 40
#: Turns of a sequence that ranges are cut by; those that agree so far are in one range, but stream through it.
KEY_TURNS = 64
#: Turns in one tree.
SHARD_TURNS = 100_000
#: Characters of joined ids in one piece.
PIECE = 1 << 16
#: Copies of each boundary node for its children to find; a node may have a third of all nodes as children.
SALTS = 64
ROOT = bytes(DIGEST)

_NODES = (
    "id binary, parent binary, parent_conv long, depth long, conv long, n_convs long, n_children long, n_leaves long, "
    "saved long, boundary boolean, part int, first binary, last binary"
)
_ARROW = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
_NODE_FIELDS = pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in _NODES.split(", "))])


def records(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows ``conv``, ``turn``, ``role``, ``record``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role in front keeps apart what would join to the same text.
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    size = F.unhex(F.lpad(F.hex(F.char_length(text).cast("long")), 2 * (RECORD - DIGEST), "0"))
    return turns.select(F.col(key).cast("long").alias("conv"), "turn", role.alias("role"), F.concat(digest, size).alias("record"))


def _id(of: Column, record: Column) -> Column:
    return F.unhex(F.sha2(F.concat(of, record), 256))


def plain_sequences(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows ``conv``, ``own``: the records of each conversation in order of turn."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("k"), "turn", "role", "record")))
    return records(turns, key).groupBy("conv").agg(F.transform(listed, lambda each: each["record"]).alias("own"))


def with_shared_heads(turns: DataFrame, key: str = "conv_id", group: int = 100, most: int = 6) -> DataFrame:
    """Rows ``conv``, ``own``: each conversation with its first turns replaced by those of the first of its group.

    The first h turns, h the CRC-32 of the id modulo ``most``, come from conversation ``id - id % group``. Rows are dealt
    by group, so the one shuffle serves the lists and the look-up; a group has at most ``group`` conversations.
    """
    dealt = records(turns, key).withColumn("first", F.col("conv") - F.col("conv") % group)
    # Rows without an id belong to no group.
    dealt = dealt.repartition("first")
    listed = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("k"), "turn", "role", "record")))
    lists = dealt.groupBy("first", "conv").agg(F.transform(listed, lambda each: each["record"]).alias("own"))
    heads = lists.where("conv = first").select("first", F.slice("own", 1, most - 1).alias("head"))
    n = F.coalesce(F.crc32(F.col("conv").cast("string")) % most, F.lit(0)).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), n)
    rest = F.slice("own", n + 1, F.greatest(F.lit(0), F.size("own") - n))
    # Both sides are dealt by group already.
    return lists.join(heads.hint("shuffle_hash"), "first", "left").select("conv", F.concat(head, rest).alias("own"))


class TernaryTree:
    """A trie whose siblings form search trees. Nodes are numbered as they are made, so parents come first."""

    def __init__(self):
        self.code, self.low, self.equal, self.high, self.parent = [], [], [], [], []
        self.root = -1
        self.ends: list[int] = []
        self.first: list[int | None] = []
        #: Sequences without a turn: their number and smallest member.
        self.empty, self.empty_first = 0, None

    def _new(self, code: int, parent: int) -> int:
        self.code.append(code)
        for links in (self.low, self.equal, self.high):
            links.append(-1)
        self.parent.append(parent)
        self.ends.append(0)
        self.first.append(None)
        return len(self.code) - 1

    def _child(self, parent: int, code: int) -> int:
        """The child of a node (-1: the root) by code, made if it is not there."""
        at = self.root if parent < 0 else self.equal[parent]
        if at < 0:
            new = self._new(code, parent)
            if parent < 0:
                self.root = new
            else:
                self.equal[parent] = new
            return new
        while True:
            known = self.code[at]
            if code == known:
                return at
            links = self.low if code < known else self.high
            if links[at] < 0:
                links[at] = self._new(code, parent)
                return links[at]
            at = links[at]

    def insert(self, codes: list[int], count: int, first: int | None) -> None:
        at = -1
        for code in codes:
            at = self._child(at, code)
        if at < 0:
            self.empty, self.empty_first = count, first
        else:
            self.ends[at], self.first[at] = count, first

    def path(self, codes: list[int]) -> Iterator[int]:
        at = -1
        for code in codes:
            at = self._child(at, code)
            yield at

    def totals(self, chars: list[int]) -> tuple[list[list], list]:
        """Of each node, then of the root: members, smallest member, children, leaves, savings."""
        n = len(self.code)
        members, least, children = list(self.ends), list(self.first), [0] * n
        leaves, saved = [0] * n, [0] * n
        # What hangs below a node in its own tree of siblings, itself included, is added up in these.
        group = [[0, None, 0, 0, 0] for _ in range(n)]
        for at in range(n - 1, -1, -1):
            below = self.equal[at]
            if below >= 0:
                other = group[below]
                members[at] += other[0]
                least[at] = _least(least[at], other[1])
                children[at], leaves[at], saved[at] = other[2], other[3], other[4]
            else:
                leaves[at] = 1
            saved[at] += (members[at] - 1) * chars[self.code[at]]
            total = group[at]
            total[:] = [members[at], least[at], 1, leaves[at], saved[at]]
            for link in (self.low[at], self.high[at]):
                if link >= 0:
                    other = group[link]
                    total[0] += other[0]
                    total[1] = _least(total[1], other[1])
                    total[2] += other[2]
                    total[3] += other[3]
                    total[4] += other[4]
        whole = group[self.root] if self.root >= 0 else [0, None, 0, 0, 0]
        root = [whole[0] + self.empty, _least(whole[1], self.empty_first), whole[2], max(1, whole[3]), whole[4]]
        return [members, least, children, leaves, saved], root


def _least(one: int | None, other: int | None) -> int | None:
    return other if one is None else one if other is None else min(one, other)


def medians(n: int) -> Iterator[int]:
    """The numbers below n, the middle first, then those of both halves."""
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            todo += [(middle + 1, high), (low, middle)]


def _cut(sequence: bytes) -> list[bytes]:
    return [sequence[at : at + RECORD] for at in range(0, len(sequence), RECORD)]


def _chars(record: bytes) -> int:
    return int.from_bytes(record[DIGEST:], "big")


def shared_records(one: bytes, other: bytes) -> int:
    """Records at the beginning of both sequences, by halving."""
    low, high = 0, min(len(one), len(other)) // RECORD
    while low < high:
        middle = (low + high + 1) // 2
        same = one[low * RECORD : middle * RECORD] == other[low * RECORD : middle * RECORD]
        low, high = (middle, high) if same else (low, middle - 1)
    return low


def junction(last: bytes, first: bytes) -> list[tuple]:
    """Corrections, by node of their common beginning, where a shard ends with ``last`` and the next begins with ``first``."""
    shared = _cut(first)[: shared_records(last, first)]
    chars = [0, *map(_chars, shared)]
    again, ended = sum(chars), len(last) == len(shared) * RECORD
    rows, own = [], ROOT
    for depth in range(len(shared) + 1):
        if depth:
            own = hashlib.sha256(own + shared[depth - 1]).digest()
        rows.append((own, None, None, depth, None, 0, -(depth < len(shared)), -ended, again, True, None, None, None))
        again -= chars[depth]
    return rows


def shard_nodes(rows: list[tuple[bytes, int, int | None]]) -> Iterator[tuple]:
    """The nodes of one shard: ``rows`` are its different sequences in order, with number and smallest of their members."""
    cut = [_cut(sequence) for sequence, _, _ in rows]
    dictionary = sorted({record for records_ in cut for record in records_})
    number = {record: code for code, record in enumerate(dictionary)}
    coded = [[number[record] for record in records_] for records_ in cut]
    tree = TernaryTree()
    for at in medians(len(rows)):
        tree.insert(coded[at], *rows[at][1:])
    (members, least, children, leaves, saved), root = tree.totals([_chars(record) for record in dictionary])
    n = len(members)
    edge = bytearray(n + 1)  # the last for the root, which has number -1 as a parent
    edge[-1] = 1
    for codes in (coded[0], coded[-1]):
        for at in tree.path(codes):
            edge[at] = 1
    yield (ROOT, None, None, 0, root[1], root[0], root[2], root[3], root[4], True, None, None, None)
    ids, depth = [b""] * n, [0] * n
    for at in range(n):
        parent = tree.parent[at]
        above = ids[parent] if parent >= 0 else ROOT
        ids[at] = hashlib.sha256(above + dictionary[tree.code[at]]).digest()
        depth[at] = depth[parent] + 1 if parent >= 0 else 1
        known = not edge[parent]
        yield (
            ids[at], None if known else above, least[parent] if known else None, depth[at], least[at], members[at],
            children[at], leaves[at], saved[at], bool(edge[at]), None, None, None,
        )


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*some, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
        )

    for row in rows:
        some.append(row)
        if len(some) >= size:
            yield batch()
            some = []
    if some:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _range_nodes(limit: int):
    """Nodes of a task's range, shard by shard, with the junctions between its shards and its own two ends."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard, turns, first, last = [], 0, None, None
        for row in _rows(batches):
            if first is None:
                first = row[0]
            if turns >= limit:
                yield from shard_nodes(shard)
                yield from junction(shard[-1][0], row[0])
                shard, turns = [], 0
            shard.append(row)
            turns += len(row[0]) // RECORD + 1
            last = row[0]
        if shard:
            yield from shard_nodes(shard)
            yield (*[None] * 9, False, TaskContext.get().partitionId(), first, last)

    return lambda batches: _batches(nodes(batches), _NODE_FIELDS)


def _junctions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches((row for last, first in _rows(batches) for row in junction(last, first)), _NODE_FIELDS)


def _between_ranges(nodes: DataFrame) -> DataFrame:
    """Junctions between the ranges of neighbouring tasks."""
    spark = nodes.sparkSession
    edges = nodes.where("part is not null").select("part", "first", "last")
    parts = sorted(row["part"] for row in edges.select("part").collect())  # one number a task
    pairs = list(zip(parts, parts[1:], strict=False))
    schema = StructType([StructField("part", IntegerType()), StructField("next", IntegerType())])
    following = edges.select(F.col("part").alias("next"), F.col("first").alias("begins"))
    joined = edges.join(spark.createDataFrame(pairs, schema), "part").join(following, "next")
    return joined.select("last", "begins").mapInArrow(_junctions, _NODES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids of equal ends, some at a time."""

    def packed() -> Iterator[tuple]:
        now, ids, size = None, [], 0
        for end, conv in _rows(batches):
            if end != now or size > PIECE:
                if ids:
                    yield now, ids[0], ",".join(map(str, ids))
                now, ids, size = end, [], 0
            if conv is not None:
                ids.append(conv)
                size += len(str(conv)) + 1
        if ids:
            yield now, ids[0], ",".join(map(str, ids))

    return _batches(packed(), pa.schema([("end", pa.binary()), ("least", pa.int64()), ("piece", pa.string())]), 1_000)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each end, in order."""

    def digests() -> Iterator[tuple]:
        now, state = None, None
        for end, _, piece in _rows(batches):
            if end != now:
                if state is not None:
                    yield now, state.hexdigest()
                now, state = end, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if state is not None:
            yield now, state.hexdigest()

    return _batches(digests(), pa.schema([("id", pa.binary()), ("ends", pa.string())]))


def _ends(members: DataFrame) -> DataFrame:
    """``id`` of each sequence's node and the digest of its members' ids."""
    ranged = members.select("end", "conv").repartitionByRange("end", "conv").sortWithinPartitions("end", "conv")
    pieces = ranged.mapInArrow(_pieces, "end binary, least long, piece string")
    ordered = pieces.repartition("end").sortWithinPartitions("end", "least")
    return ordered.mapInArrow(_hashed, "id binary, ends string")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``sequences`` (``conv``, ``own``: array of records), one row each.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent, and beside ``depth``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` there is ``node_id``, equal for equal sequences.
    """
    own = F.array_join(F.transform("own", lambda record: F.hex(record)), "")
    end = F.aggregate("own", F.lit(ROOT), lambda above, record: _id(above, record))
    members = staged(sequences.select("conv", end.alias("end"), F.unhex(own).alias("sequence")), "members")
    different = members.groupBy("end", "sequence").agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    ordered = (
        different.select("sequence", "n", "conv")
        .repartitionByRange(F.substring("sequence", 1, RECORD * KEY_TURNS))
        .sortWithinPartitions("sequence")
    )
    nodes = staged(ordered.mapInArrow(_range_nodes(shard_turns), _NODES), "nodes")
    figures = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved")]
    edges = nodes.where("boundary").unionByName(_between_ranges(nodes))
    merged = staged(
        edges.groupBy("id", "depth").agg(F.max("parent").alias("parent"), F.max("parent_conv").alias("parent_conv"), F.min("conv").alias("conv"), *figures),
        "boundary",
    )
    columns = ["id", "parent", "parent_conv", "depth", "conv", "n_convs", "n_children", "n_leaves", "saved"]
    every = nodes.where("id is not null and not boundary").select(*columns).unionByName(merged.select(*columns))
    # Children of one boundary node are dealt over its copies; the others, which know their parent's member, find none.
    parents = merged.select(
        F.col("id").alias("_of"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.col("conv").alias("_conv")
    )
    keyed = every.withColumn("_of", F.coalesce("parent", "id")).withColumn(
        "_salt", F.when(F.col("parent").isNull(), -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(SALTS))).cast("int")
    )
    linked = keyed.join(parents, ["_of", "_salt"], "left")
    ends = staged(_ends(members), "ends")
    drop_staged(members)
    return linked.join(ends, "id", "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.coalesce("parent_conv", "_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.lower(F.hex("id")).alias("node_id"),
    )


def conversation_trie(turns: DataFrame, key: str = "conv_id", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of conversations as they are; ``prefix_trie`` says what a row holds."""
    return prefix_trie(plain_sequences(turns, key), shard_turns)
