"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of words that repeats with smallest period q at least ``repeats`` times, has ``least`` words or more,
and which no neighbouring word extends with that period.

1. *Splitting.* Each word of a run stands in it at least ``repeats`` times. So a word that is rarer within a segment (at
   first the whole text) is in no run of the segment and splits it; the parts are segments again, until no word is too
   rare or the segment is too short. The segments of a block of texts are split together, in ``ROUNDS`` sorts; those not
   stable by then are finished one by one, where the largest part takes over its parent's counts less those of the
   other parts, so that text made to split word by word costs no more than n log n.
2. *Lag scan.* The surviving segments are laid end to end, the longest first, each closed by a word of its own. A run of
   period q holds three whole blocks of q words that begin at multiples of q. Sums over hashes of words compare all
   neighbouring blocks of a lag at once, n / q of them, so all lags take n log n; lag q reads only the segments with
   room for a run of it. Blocks that agree are compared word by word and extended to the run's ends.
3. Blocks inside a known run whose period divides q belong to that run, whose smallest period is known. The middle of the
   three blocks tells: two runs of different periods overlap by less than the sum of their periods, so, with periods
   taken in rising order, the run last noted there is the one in question.

Texts are read whole, in blocks of some 8 MB; a longer text is a block of its own. A null text has no words and no runs.
Words are separated by the six ASCII spaces, as bytes. Ids may be null or repeat; other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import ddl, map_blocks

LEAST, REPEATS = 6, 4
#: Sorts of a whole block before segments are finished one by one.
ROUNDS = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUNS = "array<struct<start:long,length:long,period:long>>"


def _hashes(values: np.ndarray) -> np.ndarray:
    """64 mixed bits of each number."""
    with np.errstate(over="ignore"):
        mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        return mixed ^ (mixed >> np.uint64(29))


def split_segments(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int, repeats: int) -> list[tuple[int, int]]:
    """Segments (start, end) in which every word is frequent enough, out of the given ones, in no order."""
    done: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        long_enough = ends - starts >= least
        starts, ends = starts[long_enough], ends[long_enough]
        if not len(starts):
            return done
        sizes = ends - starts
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        number = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(number)) - first[number] + starts[number]
        # Words are numbered below 2^32 in a block.
        key = number.astype(np.uint64) << np.uint64(32) | words[place].astype(np.uint64)
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        rare = count[back] < repeats
        split = np.zeros(len(starts), bool)
        split[number[rare]] = True
        done += zip(starts[~split].tolist(), ends[~split].tolist(), strict=True)
        # What is left of the others: from each beginning or rare word to the next one or the end.
        at = place[rare]
        begins = np.concatenate([starts[split], at + 1])
        order = np.argsort(begins, kind="stable")
        stops = np.concatenate([at, ends[split]])
        stop_order = np.argsort(stops, kind="stable")
        starts, ends = begins[order], stops[stop_order]
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - start >= least:
            done += _settled(words, start, end, least, repeats)
    return done


def _settled(words: np.ndarray, start: int, end: int, least: int, repeats: int) -> list[tuple[int, int]]:
    """One segment split to stability, each word's place looked up and each small part counted once a level."""
    own = words[start:end].tolist()
    places: dict[int, list[int]] = {}
    for at, word in enumerate(own):
        places.setdefault(word, []).append(at)
    done, todo = [], [(0, len(own), Counter(own), None)]
    while todo:
        low, high, count, suspects = todo.pop()
        if high - low < least:
            continue
        rare = {word for word in (count if suspects is None else suspects) if 0 < count[word] < repeats}
        if not rare:
            done.append((start + low, start + high))
            continue
        cuts = sorted(at for word in rare for at in _within(places[word], low, high))
        parts = list(zip([low, *[at + 1 for at in cuts]], [*cuts, high], strict=True))
        largest = max(range(len(parts)), key=lambda number: parts[number][1] - parts[number][0])
        changed = set()
        for number, (left, right) in enumerate(parts):
            if number != largest:
                part = Counter(own[left:right])
                count.subtract(part)
                changed.update(part)
                todo.append((left, right, part, None))
        for word in rare:
            del count[word]
        todo.append((*parts[largest], count, changed - rare))
    return done


def _within(places: list[int], low: int, high: int) -> list[int]:
    left = int(np.searchsorted(places, low)) if len(places) > 64 else 0
    found = []
    for at in places[left:]:
        if at >= high:
            break
        if at >= low:
            found.append(at)
    return found


def _agreeing(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words ``lag`` apart are equal: its first place and the one after its last."""
    n = len(words) - lag
    right, step = at, max(64, lag)
    while right < n:
        stop = min(n, right + step)
        differ = np.flatnonzero(words[right:stop] != words[right + lag : stop + lag])
        if len(differ):
            right += int(differ[0])
            break
        right, step = stop, 2 * step
    left, step = at, max(64, lag)
    while left > 0:
        stop = max(0, left - step)
        differ = np.flatnonzero(words[stop:left] != words[stop + lag : left + lag])
        if len(differ):
            left = stop + int(differ[-1]) + 1
            break
        left, step = stop, 2 * step
    return left, right


def lag_scan(words: np.ndarray, lengths: np.ndarray, least: int, repeats: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) in segments laid end to end, longest first; each ends with a word found nowhere else."""
    hashed = _hashes(words)
    n = len(words)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]).astype(np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashed * power[:n], dtype=np.uint64)])
    reach = np.cumsum(lengths)
    known_start, known_end, known_period = (np.full(n, fill, np.int64) for fill in (-1, -1, 1))
    runs: list[tuple[int, int, int]] = []
    longest = int(lengths[0]) - 1
    # Lengths fall, so their negatives rise.
    falling = 1 - lengths
    for lag in range(1, longest // repeats + 1):
        count = int(np.searchsorted(falling, -max(least, repeats * lag), side="right"))
        if not count:
            break
        with np.errstate(over="ignore"):
            block = np.diff(sums[: int(reach[count - 1]) + 1 : lag])
            same = block[:-1] * power[lag] == block[1:]
        at = np.flatnonzero(same[:-1] & same[1:])
        if not len(at):
            continue
        middle = at * lag + 3 * lag // 2
        inside = (known_start[middle] >= 0) & (known_start[middle] <= at * lag) & (known_end[middle] >= (at + 3) * lag)
        at = at[~(inside & (lag % known_period[middle] == 0))]
        done = -1
        for place in (at * lag).tolist():
            if place < done:
                continue
            left, right = _agreeing(words, place, lag)
            length = right + lag - left
            if right - place < 2 * lag or length < max(least, repeats * lag):
                continue  # two hashes met by chance, or the run is too short
            runs.append((left, right + lag, lag))
            known_start[left : right + lag], known_end[left : right + lag] = left, right + lag
            known_period[left : right + lag] = lag
            done = right + lag - 2 * lag
    return runs


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """For each text its runs (start, length, period) by start, then period; ``bounds`` cut the numbered words into texts."""
    if repeats < 4 or least < 1:
        raise ValueError("a run repeats four times or more")
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    segments = split_segments(words, bounds[:-1], bounds[1:], max(least, repeats), repeats)
    if not segments:
        return found
    segments.sort(key=lambda segment: (segment[0] - segment[1], segment[0]))
    start, end = np.array(segments).T
    own = int(words.max()) + 1
    lengths = end - start + 1
    offset = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.empty(offset[-1], np.int64)
    number = np.repeat(np.arange(len(start)), lengths)
    place = np.arange(len(flat)) - offset[number] + start[number]
    closing = place == end[number]
    flat[closing] = own + np.arange(len(start))
    flat[~closing] = words[place[~closing]]
    for left, right, period in lag_scan(flat, lengths, least, repeats):
        segment = number[left]
        begin = int(start[segment] + left - offset[segment])
        text = int(np.searchsorted(bounds, begin, side="right")) - 1
        found[text].append((begin - int(bounds[text]), right - left, period))
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run repeats, joined by spaces."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[at] for at in np.flatnonzero(kept)]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS
) -> DataFrame:
    """For each row the key, ``n_words``, its ``runs`` (start, length, period) by start, then period, and the text
    ``collapsed``: its words without those that repeat a run's first period, joined by single spaces."""

    def process(block: pa.RecordBatch) -> dict[str, list]:
        texts = block.column(block.schema.get_field_index(text)).cast(pa.large_binary())
        numbers: dict[bytes, int] = {}
        split, ids, bounds = [], [], [0]
        for value in texts:
            words = (value.as_py() or b"").split()  # the six ASCII spaces
            split.append(words)
            ids += [numbers.setdefault(word, len(numbers)) for word in words]
            bounds.append(len(ids))
        found = find_runs(np.array(ids, np.int64), np.array(bounds, np.int64), least, repeats)
        return {
            key: block.column(block.schema.get_field_index(key)),
            "n_words": [len(words) for words in split],
            "runs": [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found],
            "collapsed": [collapsed(words, runs).decode() for words, runs in zip(split, found, strict=True)],
        }

    schema = f"{ddl(docs, key)}, n_words long, runs {_RUNS}, collapsed string"
    return map_blocks(docs.select(key, text), text, schema, process)
