"""Byte-level BPE: encode texts to token ids and decode ids to bytes, by replaying merges over a block's vocabulary.

A block of documents is split into pre-tokens. Those not seen before and not whole vocabulary entries are merged
together (``merges.replay``), some ``MERGED_BYTES`` at once; then each document is put together from its pre-tokens.
Known pre-tokens are kept in a bounded memory per Python worker; a document is a list of references to them, so a block
never holds its pre-tokens as texts of their own. All state is per worker and can be rebuilt, so a lost executor costs
only its tasks.

Null texts count as empty. Empty texts have no tokens. Texts of any length are encoded whole; a pre-token of a
million letters costs n log n, not n squared. Equal rows give equal results; extra columns, whatever their names,
are carried or ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from touchline.llm.common import ddl, map_blocks, texts_of
from touchline.llm.merges import PairTable, replay

#: Pre-tokens remembered per Python worker (about 350 bytes each).
REMEMBERED = 200_000
#: Longer pre-tokens are not remembered.
LONGEST_REMEMBERED = 256
#: Bytes of pre-tokens merged together, at least one pre-token; some 100 times as many are held meanwhile.
MERGED_BYTES = 1 << 19


class Known(dict):
    """Entries by pre-token: its ids as decimal text, and the bytes its ids decode to.

    A pre-token that is looked up for the first time gets an entry to be filled, and is named in ``fresh``.
    """

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> list:
        entry = self[piece] = [None, None]
        self.fresh.append(piece)
        return entry


class ByteBPE:
    """A byte-level vocabulary of ranks with its pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, number in ranks.items():
            self.tokens[number] = token
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.table = PairTable(self.tokens, list(range(size)))
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.known = Known()

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBPE:
        lines = Path(path).read_bytes().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}
        return cls(ranks, pattern)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. A piece that is a vocabulary entry is that entry, as in the library."""
        results: list[list[int]] = [[self.ranks[piece]] if piece in self.ranks else [] for piece in pieces]
        rest = [number for number, result in enumerate(results) if not result and pieces[number]]
        lengths = np.array([len(pieces[number]) for number in rest], np.int64)
        flat = np.frombuffer(b"".join([pieces[number] for number in rest]), np.uint8)
        merged, counts = replay(self.byte_ids[flat], lengths, self.table)
        ids, start = merged.tolist(), 0
        for number, count in zip(rest, counts.tolist(), strict=True):
            results[number] = ids[start : start + count]
            start += count
        return results

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[number] for number in ids])

    def merge_runs(self, pieces: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each piece with its ids, merged in runs of about ``MERGED_BYTES``."""
        run, size = [], 0
        for number, piece in enumerate(pieces, 1):
            run.append(piece.encode())
            size += len(run[-1])
            if size >= MERGED_BYTES or number == len(pieces):
                yield from zip(pieces[number - len(run) : number], self.merge(run), strict=True)
                run, size = [], 0

    def look_up(self, split: Iterable[list[str]]) -> list[list[list]]:
        """For each pre-token of each text its entry: its ids as decimal text, and the bytes its ids decode to."""
        if len(self.known) > REMEMBERED:
            self.known = Known()
        known = self.known
        try:
            found = [list(map(known.__getitem__, pieces)) for pieces in split]
            for piece, ids in self.merge_runs(known.fresh):
                known[piece][:] = ",".join(map(str, ids)), self.decode(ids)
                if len(piece) > LONGEST_REMEMBERED:
                    del known[piece]
            known.fresh = []
        except BaseException:
            self.known = Known()  # some entries are not filled
            raise
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.pattern.findall(text) for text in texts]
        distinct = list(dict.fromkeys(piece for pieces in split for piece in pieces))
        ids = dict(self.merge_runs(distinct))
        return [[number for piece in pieces for number in ids[piece]] for pieces in split]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> ByteBPE:
    """The vocabulary, loaded once per Python worker."""
    return ByteBPE.from_file(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the token ids of each text as an array column."""
    def process(block: pa.RecordBatch) -> dict[str, list]:
        columns = {name: block.column(number) for number, name in enumerate(block.schema.names) if name != out}
        return columns | {out: vocabulary(path, pattern).encode(texts_of(block, text))}

    return map_blocks(docs, text, f"{ddl(docs.drop(out))}, `{out}` array<int>", process)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids give null."""
    def process(block: pa.RecordBatch) -> dict[str, list]:
        columns = {name: block.column(number) for number, name in enumerate(block.schema.names) if name != out}
        words = vocabulary(path, pattern)
        lists = block.column(block.schema.get_field_index(ids)).to_pylist()
        return columns | {out: [None if numbers is None else words.decode(numbers) for numbers in lists]}

    return map_blocks(tokens, ids, f"{ddl(tokens.drop(out))}, `{out}` binary", process)


def token_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of tokens, SHA-256 of the ids as decimal text joined by commas, SHA-256 of the decoded bytes."""

    def process(block: pa.RecordBatch) -> dict[str, list]:
        words = vocabulary(path, pattern)
        split = (words.pattern.findall(value) for value in texts_of(block, text))
        counts, ids_digests, decoded_digests = [], [], []
        for found in words.look_up(split):
            ids = ",".join([entry[0] for entry in found]).encode()
            counts.append(ids.count(b",") + 1 if ids else 0)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            decoded_digests.append(hashlib.sha256(b"".join([entry[1] for entry in found])).hexdigest())
        return {
            key: block.column(block.schema.get_field_index(key)),
            "n_tokens": counts,
            "ids_sha256": ids_digests,
            "decoded_sha256": decoded_digests,
        }

    key_type = dict(docs.dtypes)[key]
    schema = f"`{key}` {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_blocks(docs.select(key, text), text, schema, process)
