"""Byte-pair merges of many strings at once, replayed in rank order.

The strings of a block form one flat array of symbols with links to the neighbours in the same string. An inverted
index holds, for each merge rank, the positions where a pair of that rank begins. The lowest rank in the index is
taken, all its positions are merged in one step, and only the pairs left and right of them are looked up again and
entered anew.

Both reference libraries work string by string: they merge the lowest rank first and the leftmost pair of it. Strings
do not influence each other, so the order between strings is free. Within a string, a merge may create a pair of a
rank that is not higher than its own; then the one-step merge of all positions could go another way. Such strings
are found during the replay and done again one pair at a time, so the result is the libraries' in every case.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

NONE = np.iinfo(np.int32).max


class PairTable:
    """Rank and result of every pair of symbols whose concatenation is a vocabulary entry."""

    def __init__(self, tokens: list, rank_of: list[int]):
        """``tokens`` are byte strings or texts by symbol, ``rank_of`` their ranks; a lower rank merges first."""
        symbol = {token: number for number, token in enumerate(tokens)}
        self.base = len(tokens)
        left, right, into = [], [], []
        for number, token in enumerate(tokens):
            for cut in range(1, len(token)):
                first, second = symbol.get(token[:cut]), symbol.get(token[cut:])
                if first is not None and second is not None:
                    left.append(first)
                    right.append(second)
                    into.append(number)
        keys = np.array(left, np.int64) * self.base + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.into = np.append(np.array(into, np.int32)[order], 0).astype(np.int32)
        self.rank = np.append(np.array(rank_of, np.int32)[self.into[:-1]], NONE).astype(np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result for each pair; rank ``NONE`` where there is no merge. Negative symbols never merge."""
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, keys)
        known = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], NONE), self.into[at]

    def find_one(self, left: int, right: int) -> tuple[int, int]:
        rank, into = self.find(np.array([left]), np.array([right]))
        return int(rank[0]), int(into[0])


def replay(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge all strings; returns the merged symbols, flat, and the number of symbols per string.

    ``symbols`` holds the first symbols of all strings in a row, ``lengths`` how many each string has. A negative
    symbol is one that never merges.
    """
    total = len(symbols)
    if not total:
        return symbols.astype(np.int32), np.zeros(len(lengths), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ids = symbols.astype(np.int32)
    inside = np.zeros(total, bool)
    inside[:-1] = owner[:-1] == owner[1:]
    following = np.where(inside, np.arange(1, total + 1), -1)
    before = np.full(total, -1)
    before[1:] = np.where(inside[:-1], np.arange(total - 1), -1)
    rank = np.full(total, NONE, np.int32)
    into = np.zeros(total, np.int32)
    at = np.flatnonzero(inside)
    rank[at], into[at] = table.find(ids[at], ids[at + 1])
    gone = np.zeros(total, bool)
    irregular = np.zeros(len(lengths), bool)

    index: dict[int, list[np.ndarray]] = {}

    def enter(positions: np.ndarray) -> list[int]:
        """Add positions to the index under their present rank; returns the ranks that are new in it."""
        positions = positions[rank[positions] != NONE]
        if not len(positions):
            return []
        positions = positions[np.argsort(rank[positions], kind="stable")]
        ranks = rank[positions]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        fresh = []
        for value, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts), strict=True):
            if value in index:
                index[value].append(part)
            else:
                index[value] = [part]
                fresh.append(value)
        return fresh

    heap = enter(at)
    heapify(heap)
    while heap:
        lowest = heappop(heap)
        parts = index.pop(lowest)
        found = np.concatenate(parts) if len(parts) > 1 else parts[0]
        found = np.unique(found[rank[found] == lowest])
        if not len(found):
            continue
        # Of pairs that overlap in a run, every second one merges, from the left.
        first = np.ones(len(found), bool)
        first[1:] = following[found[:-1]] != found[1:]
        if not first.all():
            starts = np.flatnonzero(first)
            offset = np.arange(len(found)) - starts[np.cumsum(first) - 1]
            found = found[offset % 2 == 0]
        taken = following[found]
        after = following[taken]
        has_after = after >= 0
        left, nearest = found[has_after], after[has_after]
        early, _ = table.find(into[left], ids[nearest])
        irregular[owner[left[early <= lowest]]] = True

        ids[found] = into[found]
        following[found] = after
        before[nearest] = left
        gone[taken] = True
        rank[taken] = NONE
        rank[found] = NONE
        rank[left], into[left] = table.find(ids[left], ids[nearest])
        previous = before[found]
        has_before = previous >= 0
        right, previous = found[has_before], previous[has_before]
        rank[previous], into[previous] = table.find(ids[previous], ids[right])
        touched = np.concatenate([left, previous])
        irregular[owner[touched[rank[touched] <= lowest]]] = True
        for value in enter(touched):
            heappush(heap, value)

    counts = np.bincount(owner[~gone], minlength=len(lengths))
    merged = ids[~gone]
    if irregular.any():
        starts = np.cumsum(lengths) - lengths
        pieces = np.split(merged, np.cumsum(counts)[:-1])
        for number in np.flatnonzero(irregular):
            own = symbols[starts[number] : starts[number] + lengths[number]]
            pieces[number] = np.array(merge_one(own.tolist(), table), np.int32)
        counts = np.array([len(piece) for piece in pieces])
        merged = np.concatenate(pieces)
    return merged, counts


def merge_one(symbols: list[int], table: PairTable) -> list[int]:
    """Merge one string pair by pair: the lowest rank first, the leftmost of equal ranks first."""
    size = len(symbols)
    ids = list(symbols)
    following, before = [*range(1, size), -1], [-1, *range(size - 1)]
    ranks, results = table.find(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)) if size > 1 else ([], [])
    current = [*map(int, ranks), NONE]
    into = [*map(int, results), 0]
    heap = [(value, at) for at, value in enumerate(current) if value != NONE]
    heapify(heap)
    alive = [True] * size

    def look(at: int) -> None:
        right = following[at]
        current[at], into[at] = table.find_one(ids[at], ids[right]) if right >= 0 else (NONE, 0)
        if current[at] != NONE:
            heappush(heap, (current[at], at))

    while heap:
        value, at = heappop(heap)
        if not alive[at] or current[at] != value:
            continue
        right = following[at]
        ids[at] = into[at]
        alive[right] = False
        following[at] = following[right]
        if following[at] >= 0:
            before[following[at]] = at
        look(at)
        if before[at] >= 0:
            look(before[at])
    return [number for number, here in zip(ids, alive, strict=True) if here]
