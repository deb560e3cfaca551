"""Secret scan: rules find the plain cases; a character convolutional network reads every candidate in its context.

1. One pass over whole texts finds the spans of the rules (``assign``, ``access``, ``hex``) and the *candidates*: the
   secrets in those spans, and all runs of 8 or more characters that a secret may consist of, unless those spans cover
   them wholly.
2. The network is trained on labelled findings: candidates in a rule's span are secrets. Others are taken for no
   secrets if they touch none and look like words, numbers or names; nothing is learned from a run of secret-like shape
   (letters and digits mixed, or upper and lower case unlike words), which may be a bare key. Each
   secret is also shown with another candidate's surroundings, so that its own characters must tell. In such surroundings
   there are planted ``PLANTED`` random keys of various lengths and alphabets, since the rules know few kinds, and as many
   decoys: addresses, card and phone numbers, dates, ids, names of files, hosts and variables.
   It begins on a bounded sample: some ``TEXTS`` different texts, those whose hash is below a bound that follows from the
   number of rows (all texts, if those hold too few candidates), and ``SAMPLE`` different windows of secrets and
   ``OTHERS`` others out of them, those with the smallest hashes. Then it learns from all texts but the held ones: a pass
   over them scores every finding and collects all secrets and all others but those whose chance is below
   ``_COLLECTED``. The loss is flat up to a chance of ``FLAT``, so the rest would change nothing. The windows are dealt to
   ``_READERS`` tasks by hash; each learns from its own, in order of hash, and the mean of their networks goes on. Half
   way the texts are read again for windows that the changed network no longer puts below ``_COLLECTED``.
3. A fifth of the texts, by their CRC-32, is held out. On all findings there the output is calibrated (a logistic curve),
   and the threshold is the highest that still finds ``RECALL`` of the rules' secrets there, also in other surroundings,
   and of the held planted keys of ``SURE`` characters or more. If less than ``PRECISION`` of what it finds there are
   secrets, it rises as far as ``LEAST_RECALL`` of them allows.
4. Every candidate is scored. One outside the rules' spans that reaches the threshold adds a span, ``cnn``. The
   convolution of a few characters is a sum over their places, so it is looked up in tables of pairs of characters.

A candidate over ``INSIDE`` characters is read in windows of that width, one every ``STEP`` characters, so that all of
it is read and any ``INSIDE`` - ``STEP`` characters stand together in one window; what stands between its separators
(``/``, dots and the like) is read by itself too, so that a key in a path is not diluted. Its score is the highest.

Null texts count as empty. Without candidates that are no secrets, or without any text, no span is added. Long texts are
searched whole. Each pass reads the texts again, so that candidates are nowhere stored. Repeated rows and ids are rows of
their own; equal windows teach once, but count as often as they occur in calibration and threshold. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import blocks, ddl, drop_staged, map_blocks, staged, texts_of

#: Fixed values of the contract: patterns, kinds in the order listed, least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "cnn")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
#: What the assign rule begins with, in lower case.
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs that are too short fail, so only longer ones need be found, from their beginning.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4))
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST_HEX)
#: Of each byte, whether a candidate may hold it.
_IN_RUN = np.array([re.fullmatch(r"[A-Za-z0-9+/_=.-]", chr(code)) is not None for code in range(256)])
_PART = re.compile(r"[A-Za-z0-9+]{8,}")
#: Shapes of words and numbers; other parts mix classes of characters as keys do.
#: There is one way to read each, so that a long run that is none takes time in proportion to its length.
_WORDLIKE = re.compile(r"\d+|[A-Z]+|[A-Z]{0,2}[a-z]+\d{0,2}|(?:[a-z]{2,})?(?:[A-Z][a-z]{2,})+")
_MIXED_PART = re.compile(r"[A-Za-z0-9]+")

BEFORE, INSIDE, AFTER = 24, 48, 16
WIDTH = BEFORE + INSIDE + AFTER
#: Characters from one window of a long candidate to the next.
STEP = 16
TEXTS, SAMPLE, PLANTED, OTHERS = 20_000, 2_000, 2_000, 20_000
RECALL, LEAST_RECALL, PRECISION, SURE = 0.97, 0.93, 0.99, 12
#: Tasks that read the texts of the sample.
_READERS = 16
#: What planted keys consist of.
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALPHABETS = (
    _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER + _DIGITS, _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS,
    _LOWER + _UPPER + _DIGITS + "+/", _LOWER + _UPPER + _DIGITS + "-_",
)
#: Short words of names in programs.
_NAMES = ("min", "total", "count", "name", "path", "index", "limit", "default", "user", "file", "lib", "test", "api", "log")
_EMBEDDING, _REACH, _FILTERS = 10, 5, 24
_EPOCHS, _BATCH, _RATE = 4, 128, 0.01
#: Training on all findings: errors of a chance up to this count as none; rates of its passes; before each
#: group of them the texts are read for what there is to learn.
FLAT = 0.02
#: Others are collected from this chance on, so that few reach ``FLAT`` while the network changes.
_COLLECTED = 0.005
_RATES = ((0.005, 0.005, 0.003), (0.002, 0.0005))
#: Least steps of a task in a pass.
_LEAST_STEPS = 40
#: Keys and decoys planted for it.
_POOL = 8_000
#: Steps in which outputs of held findings are counted.
_STEPS = 256
#: Windows scored at once.
_AT_ONCE = 1024
#: Classes of characters: padding, printable ASCII, other letters, all else.
_LETTER, _OTHER, _CLASSES = 96, 97, 98
#: The class of each ASCII character.
_CLASS_OF = np.array([code - 31 if 32 <= code < 127 else _OTHER for code in range(128)], np.uint8)

Window = tuple[str, str, str]

_SPAN = "struct<kind:int,start:long,end:long>"
_FOUND = "struct<start:long,end:long,before:string,inside:string,after:string,secret:boolean>"


def _runs(texts: list[str]) -> list[list[tuple[int, int]]]:
    """For each text the runs of ``LEAST_ASSIGN`` or more characters that a secret may consist of."""
    # One byte for each character; all others, like what stands between texts, end a run.
    codes = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("ascii", "replace"), np.uint8)
    inside = _IN_RUN.take(codes)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]  # counted without what stands before the first text
    long_enough = end - start >= LEAST_ASSIGN
    start, end = start[long_enough], end[long_enough]
    lengths = np.array([len(text) for text in texts], np.int64)
    first = np.cumsum(lengths + 1) - lengths - 1
    bounds = np.searchsorted(start, np.append(first, len(codes)))
    shift = np.repeat(first, np.diff(bounds))
    every = list(zip((start - shift).tolist(), (end - shift).tolist(), strict=True))
    return [every[at:to] for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _assigned(text: str) -> Iterator[re.Match]:
    """The matches of the assign rule, looked for where its words are."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a capital became two characters, so places differ
        yield from _ASSIGN.finditer(text)
        return
    places = []
    for word in _WORDS:
        at = lowered.find(word)
        while at >= 0:
            places.append(at)
            at = lowered.find(word, at + 1)
    end = 0
    for at in sorted(places):
        if at >= end and (match := _ASSIGN.match(text, at)):
            end = match.end()
            yield match


def rule_spans(
    text: str, runs: list[tuple[int, int]] | None = None
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans of the rules by start, then kind; and the secrets inside them. ``runs`` are those of ``_runs``, if known."""
    spans, secrets = [], []
    for match in _assigned(text):
        if match.end(2) - match.start(2) >= LEAST_ASSIGN:
            spans.append((0, *match.span()))
            secrets.append(match.span(2))
    if "AKIA" in text:
        found = [match.span() for match in _ACCESS.finditer(text)]
        spans += [(1, *span) for span in found]
        secrets += found
    # Hex digits are characters of candidates too.
    long_ = [run for run in (_runs([text])[0] if runs is None else runs) if run[1] - run[0] >= LEAST_HEX]
    found = [match.span() for run in long_ for match in _HEX.finditer(text, *run)]
    spans += [(2, *span) for span in found]
    secrets += found
    return sorted(spans, key=lambda span: (span[1], span[0])), secrets


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap made one."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def candidates_of(
    value: str, labelled: bool = True
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, bool | None]]]:
    """Spans of the rules, and the candidates: start, end, whether it is a secret; None if unknown: only a part of it is, or its shape is
    that of one. If they need not be ``labelled``, shapes are not looked at."""
    return candidates_of_all([value], labelled)[0]


def candidates_of_all(
    texts: list[str], labelled: bool = True
) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, bool | None]]]]:
    """``candidates_of`` each text."""
    return [_candidates(value, runs, labelled) for value, runs in zip(texts, _runs(texts), strict=True)]


def _candidates(
    value: str, runs: list[tuple[int, int]], labelled: bool
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, bool | None]]]:
    def label(start: int, end: int) -> bool | None:
        return None if labelled and secret_like(value[start:end]) else False

    spans, secrets = rule_spans(value, runs)
    if not spans:
        return spans, [(start, end, label(start, end)) for start, end in runs]
    own = [(start, end, True) for start, end in dict.fromkeys(secrets)]
    covered = _merged([(start, end) for _, start, end in spans])
    at = 0
    for start, end in runs:  # both run from left to right
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        last, place = at, start
        while last < len(covered) and covered[last][0] < end:
            if covered[last][0] > place:
                break
            place, last = covered[last][1], last + 1
        if place < end:
            partly = at < len(covered) and covered[at][0] < end
            own.append((start, end, None if partly else label(start, end)))
    return spans, own


def secret_like(run: str) -> bool:
    """Whether parts that are neither words nor numbers make up as many characters as a short secret has."""
    if run.islower() and run.isalpha():
        return False
    parts = _MIXED_PART.findall(run)
    return sum(len(part) for part in parts if not _WORDLIKE.fullmatch(part)) >= LEAST_ASSIGN


def pieces(start: int, end: int) -> Iterator[tuple[int, int]]:
    """The parts of a candidate that a window reads: itself, or overlapping ones that cover it."""
    last = max(start, end - INSIDE)
    for at in range(start, last, STEP):
        yield at, at + INSIDE
    yield last, end


def reads(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The pieces of a candidate and, of a long one, the parts between its separators."""
    yield from pieces(start, end)
    if end - start > INSIDE:
        for part in _PART.finditer(text, start, end):
            yield from pieces(*part.span())


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the rules' ``spans`` and the ``candidates`` with what is around them."""

    def process(block: pa.RecordBatch) -> dict[str, list]:
        all_spans, all_candidates = [], []
        texts = texts_of(block, text)
        for value, (spans, own) in zip(texts, candidates_of_all(texts), strict=True):
            all_spans.append([{"kind": kind, "start": start, "end": end} for kind, start, end in spans])
            all_candidates.append(
                [
                    {
                        "start": start,
                        "end": end,
                        "before": value[max(0, start - BEFORE) : start],
                        "inside": value[start:end],
                        "after": value[end : end + AFTER],
                        "secret": secret,
                    }
                    for start, end, secret in own
                ]
            )
        columns = {key: block.column(block.schema.get_field_index(key))}
        return columns | {"spans": all_spans, "candidates": all_candidates}

    schema = f"{ddl(docs, key)}, spans array<{_SPAN}>, candidates array<{_FOUND}>"
    return map_blocks(docs.select(key, text), text, schema, process)


def _classes(text: str) -> np.ndarray:
    """Class of each character."""
    if text.isascii():
        return _CLASS_OF.take(np.frombuffer(text.encode(), np.uint8))
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    classes = _CLASS_OF.take(np.minimum(codes, 127))
    far = np.flatnonzero(codes > 127)
    if len(far):
        different, place = np.unique(codes[far], return_inverse=True)
        classes[far] = np.array([_LETTER if chr(code).isalpha() else _OTHER for code in different], np.uint8)[place]
    return classes


def windows(candidates: list[Window]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters of windows, and which of them are the candidate's."""
    if not candidates:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH))
    classes = _classes("".join(map("".join, candidates)))
    sizes = np.array([[len(part) for part in window] for window in candidates])
    start, end = sizes[:, :1], sizes[:, :2].sum(axis=1, keepdims=True)
    total = sizes.sum(axis=1, keepdims=True)
    place = np.arange(WIDTH)
    at = start + (place - BEFORE)
    known = (at >= 0) & (at < np.minimum(end + AFTER, total))
    first = np.cumsum(total)[:, None] - total
    ids = np.where(known, classes[np.clip(first + at, 0, len(classes) - 1)], 0) if len(classes) else np.zeros_like(at)
    return ids, ((place >= BEFORE) & (at < end)).astype(np.float32)


class _Steps:
    """Adam's steps on the parts of a network, in place."""

    def __init__(self, state: list[np.ndarray]):
        self.state, self.number = state, 0
        self.first, self.second = [np.zeros_like(part) for part in state], [np.zeros_like(part) for part in state]

    def step(self, gradients: list[np.ndarray], rate: float) -> None:
        self.number += 1
        for part, one, two, gradient in zip(self.state, self.first, self.second, gradients, strict=True):
            one += 0.1 * (gradient - one)
            two += 0.01 * (gradient**2 - two)
            part -= rate * (one / (1 - 0.9**self.number)) / (np.sqrt(two / (1 - 0.99**self.number)) + 1e-8)


@dataclass
class Network:
    """Embedding, one convolution, maximum and mean over the window, one linear output; then a logistic curve."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def forward(self, ids: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, tuple]:
        signal = np.concatenate([self.embedding[ids], inside[:, :, None]], axis=2)
        view = np.lib.stride_tricks.sliding_window_view(signal, _REACH, axis=1)
        spread = view.transpose(0, 1, 3, 2).reshape(len(ids), WIDTH - _REACH + 1, -1)
        active = (spread.reshape(-1, len(self.filters)) @ self.filters).reshape(*spread.shape[:2], _FILTERS) + self.bias
        active = np.maximum(active, np.zeros_like(active), out=active)  # an array, since a number takes four times as long
        one = np.ones((len(ids), 1), active.dtype)
        pooled = np.concatenate([active.max(axis=1), active.mean(axis=1), one], axis=1)
        return pooled @ self.output, (spread, active, pooled)

    def gradients(self, ids: np.ndarray, inside: np.ndarray, target: np.ndarray, flat: float = 0.0) -> list[np.ndarray]:
        """Of the mean logistic loss, or of one that is flat where the chance is off by ``flat`` at most."""
        number = len(ids)
        if flat:  # the others add nothing to the sums below; that is seen by the tables, with a margin
            logit = self.quick_logits(ids, inside)
            own = np.flatnonzero(np.abs(1 / (1 + np.exp(-np.clip(logit, -40, 40))) - target) > flat - 1e-4)
            if not len(own):
                return [np.zeros_like(part) for part in self.state]
            ids, inside, target = ids[own], inside[own], target[own]
        logit, (spread, active, pooled) = self.forward(ids, inside)
        error = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - target
        error = (np.sign(error) * np.maximum(np.abs(error) - flat, 0) / number).astype(self.output.dtype)
        by_pooled = error[:, None] * self.output[None, :-1]
        by_active = np.empty_like(active)
        by_active[:] = by_pooled[:, None, _FILTERS:] / active.shape[1]
        best = active.argmax(axis=1)
        rows = np.arange(len(ids))[:, None]
        by_active[rows, best, np.arange(_FILTERS)[None, :]] += by_pooled[:, :_FILTERS]
        by_active *= active > 0
        by_place = by_active.reshape(-1, _FILTERS)
        by_filters = spread.reshape(len(by_place), -1).T @ by_place
        by_spread = (by_place @ self.filters.T).reshape(len(ids), -1, _REACH, _EMBEDDING + 1)
        by_signal = np.zeros((len(ids), WIDTH, _EMBEDDING + 1), error.dtype)
        for offset in range(_REACH):
            by_signal[:, offset : offset + active.shape[1]] += by_spread[:, :, offset]
        places = ids.ravel()
        by_embedding = np.column_stack(
            [
                np.bincount(places, weights=by_signal[:, :, number].ravel(), minlength=_CLASSES)
                for number in range(_EMBEDDING)
            ]
        )
        return [by_embedding, by_filters, by_place.sum(axis=0), pooled.T @ error]

    @property
    def state(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.output]

    def probabilities(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """The calibrated output of ``forward``."""
        return self.calibrated(self.forward_all(ids, inside))

    def forward_all(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """As ``forward``, some windows at a time."""
        some = [self.forward(ids[at : at + 256], inside[at : at + 256])[0] for at in range(0, len(ids), 256)]
        return np.concatenate(some or [np.zeros(0)])

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -40, 40)))

    def tables(self, wide: int = 2) -> list[np.ndarray]:
        """What ``wide`` characters in a row add to the filters at two places in a row, in single precision.

        One table for each such run of characters that the two places reach. A character inside the candidate has a
        number of its own, that of its class and ``_CLASSES`` more.
        """
        filters = self.filters.reshape(_REACH, _EMBEDDING + 1, _FILTERS)
        outside = self.embedding @ filters[:, :-1]
        one = np.concatenate([outside, outside + filters[:, -1:, :]], axis=1)
        none = np.zeros_like(one[:1])
        # The first place does not reach the last character, the second not the first.
        one = np.concatenate([np.concatenate([one, none]), np.concatenate([none, one])], axis=2)
        one[0] += np.append(self.bias, np.zeros_like(self.bias))
        one[1, :, _FILTERS:] += self.bias
        one = one.astype(np.float32)
        if wide == 1:
            return list(one)
        return [(one[at][:, None] + one[at + 1][None]).reshape(-1, 2 * _FILTERS) for at in range(0, _REACH + 1, 2)]

    def logits(self, classes: np.ndarray, start: np.ndarray, end: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """As ``forward``, in single precision, for windows (``start``, ``end``) of padded ``classes``, the longest first.

        A window's places are its characters with what is around them; what ``forward`` reads behind them is padding.
        """
        size = end - start + BEFORE + AFTER
        # One row for each place, one column for each window. Most are as long as the shortest.
        at = np.arange(int(size[0]) + _REACH + 1)[:, None]
        code = classes.take(at + (start - BEFORE)).astype(np.intp)
        least = int(size[-1])
        code[least:] *= at[least:] < size
        code[BEFORE : least - AFTER] += _CLASSES
        code[least - AFTER :] += _CLASSES * (at[least - AFTER :] < size - AFTER)
        return self._pooled(code[:-1] * (2 * _CLASSES) + code[1:], size, tables)

    def quick_logits(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """As ``forward``, in single precision, for ``windows``."""
        size = np.minimum(BEFORE + inside.sum(axis=1).astype(int) + AFTER, WIDTH)
        order = np.argsort(-size, kind="stable")
        code = np.zeros((WIDTH + _REACH + 1, len(ids)), np.intp)
        code[:WIDTH] = (ids + _CLASSES * (inside > 0))[order].T
        logit = np.empty(len(ids))
        logit[order] = self._pooled(code, size[order], self.tables(1))
        return logit

    def _pooled(self, code: np.ndarray, size: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """The output for windows of ``size`` characters, the longest first: a column of ``code`` each.

        Two places at a time, so that what is held of them stays in the processor's cache.
        """
        places, step = WIDTH - _REACH + 1, (_REACH + 1) // len(tables)
        best, total, active, part, zero = (np.zeros((len(size), 2 * _FILTERS), np.float32) for _ in range(5))
        starts = np.arange(0, min(int(size[0]), places), 2)
        counts = np.searchsorted(-size, -starts)
        for place, count in zip(starts.tolist(), counts.tolist(), strict=True):  # so many windows are longer than that
            own, more = active[:count], part[:count]
            for number, table in enumerate(tables):
                to = more if number else own
                table.take(code[place + number * step, :count], axis=0, out=to, mode="clip")
                if number:
                    own += more
            np.maximum(own, zero[:count], out=own)
            np.maximum(best[:count], own, out=best[:count])
            total[:count] += own
        best = np.maximum(best[:, :_FILTERS], best[:, _FILTERS:])
        total = total[:, :_FILTERS] + total[:, _FILTERS:]
        padding = np.maximum(sum(table[0, :_FILTERS] for table in tables), 0)
        read = size + size % 2
        short = read < places
        best[short] = np.maximum(best[short], padding)
        total[short] += (places - read[short])[:, None].astype(np.float32) * padding
        return best @ self.output[:_FILTERS] + total @ self.output[_FILTERS:-1] / places + self.output[-1]

    def score_all(self, texts: list[str], candidates: list[list[tuple[int, int]]]) -> list[np.ndarray]:
        """For each text the highest probability of each candidate's windows."""
        if not texts:
            return []
        chances = self.calibrated(np.concatenate(self.logits_all(texts, candidates)))
        return np.split(chances, np.cumsum([len(own) for own in candidates])[:-1])

    def logits_all(self, texts: list[str], candidates: list[list[tuple[int, int]]]) -> list[np.ndarray]:
        """For each text the highest output of each candidate's windows, not calibrated."""
        counts = [len(own) for own in candidates]
        best = np.full(sum(counts), -np.inf)
        if not len(best):
            return [np.zeros(0) for _ in counts]
        tables = self.tables()
        # Texts one after the other, with padding between them that is as wide as a window's surroundings.
        lengths = np.array([len(text) for text in texts])
        place = np.cumsum(lengths + BEFORE) - lengths
        joined = _classes("".join(texts))
        classes = np.zeros(int(place[-1] + lengths[-1]) + WIDTH, np.uint8)
        source = np.cumsum(lengths) - lengths
        for to, from_, length in zip(place.tolist(), source.tolist(), lengths.tolist(), strict=True):
            classes[to : to + length] = joined[from_ : from_ + length]
        # Candidates that one window reads, which nearly all are, and the pieces of the others.
        places = chain.from_iterable(chain.from_iterable(candidates))
        flat = np.fromiter(places, np.int64, 2 * len(best)).reshape(-1, 2)
        owner = np.repeat(np.arange(len(texts)), counts)
        size = flat[:, 1] - flat[:, 0]
        short = np.flatnonzero(size <= INSIDE)
        short = short[np.argsort(-size[short], kind="stable")]  # windows of like width together

        def take(number: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
            shift = place[owner[number]]
            np.maximum.at(best, number, self.logits(classes, start + shift, end + shift, tables))

        for at in range(0, len(short), _AT_ONCE):
            number = short[at : at + _AT_ONCE]
            take(number, flat[number, 0], flat[number, 1])
        long_ = np.flatnonzero(size > INSIDE).tolist()
        every = ((number, *piece) for number in long_ for piece in reads(texts[owner[number]], *flat[number].tolist()))
        while some := list(islice(every, _AT_ONCE)):
            some.sort(key=lambda piece: piece[1] - piece[2])
            take(*np.array(some).T)
        return np.split(best, np.cumsum(counts)[:-1])

    def score(self, text: str, candidates: list[tuple[int, int]]) -> np.ndarray:
        """The highest probability of each candidate's windows."""
        return self.score_all([text], [candidates])[0]


def _least(found: Iterable[tuple[Window, bool]], most: dict[bool, int]) -> list[tuple[bytes, Window, bool]]:
    """Of each label as many different windows as it may have, those with the smallest hashes."""
    kept: dict[bool, dict[Window, bytes]] = {True: {}, False: {}}
    bound = {True: b"\xff" * 9, False: b"\xff" * 9}
    for window, secret in found:
        mark = _mark(window)
        own = kept[secret]
        if mark <= bound[secret]:
            own[window] = mark
            if len(own) > 2 * most[secret]:
                kept[secret] = dict(sorted(own.items(), key=lambda item: (item[1], item[0]))[: most[secret]])
                bound[secret] = max(kept[secret].values())
    return [
        (mark, window, secret)
        for secret, own in kept.items()
        for window, mark in sorted(own.items(), key=lambda item: (item[1], item[0]))[: most[secret]]
    ]


def _cut(text: str, start: int, end: int, secret: bool) -> Iterator[Window]:
    """What to learn from a candidate; the parts of a secret may be words."""
    for at, to in pieces(start, end) if secret else reads(text, start, end):
        yield text[max(0, at - BEFORE) : at], text[at:to], text[to : to + AFTER]


def _of_texts(block: pa.RecordBatch) -> Iterator[tuple[Window, bool]]:
    texts = texts_of(block, "_read")
    for text, (_, own) in zip(texts, candidates_of_all(texts), strict=True):
        for start, end, secret in own:
            if secret is None:
                continue
            for window in _cut(text, start, end, secret):
                yield window, secret


def _of_findings(block: pa.RecordBatch) -> Iterator[tuple[Window, bool]]:
    for found in block.column(block.schema.get_field_index("_read")).to_pylist():
        for one in found or ():
            if one["secret"] is None:
                continue
            text, start = one["before"] + one["inside"] + one["after"], len(one["before"])
            for window in _cut(text, start, start + len(one["inside"]), one["secret"]):
                yield window, one["secret"]


def sampled_texts(docs: DataFrame, text: str, texts: int = TEXTS) -> DataFrame:
    """Some ``texts`` different texts (``_read``) to begin with: those whose hash is below a bound, or all.

    Neither the driver nor a task compares hashes, so it costs one pass at any size.
    """
    rows = docs.count()
    value = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_read"))
    if rows > texts:
        bound = -(1 << 63) + ((1 << 64) * texts // rows)
        value = value.where(F.xxhash64("_read") < F.lit(bound).cast("long"))
    return value.dropDuplicates(["_read"]).repartition(_READERS)


def _sampled(rows: DataFrame, read, sample: int, others: int = OTHERS) -> tuple[list[Window], list[Window]]:
    """Up to ``sample`` different windows that are secrets and ``others`` that are not. One that is both is a secret."""
    most = {True: sample, False: others}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (each for block in blocks(batches, "_read") for each in read(block))
        found = [(mark, *window, secret) for mark, window, secret in _least(every, most)]
        names = ["mark", "before", "inside", "after", "secret"]
        types = [pa.binary(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        columns = list(zip(*found, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names
        )

    each = rows.mapInArrow(run, "mark binary, before string, inside string, after string, secret boolean")
    # At most ``most`` windows of each label from each of ``_READERS`` tasks.
    each = staged(each.groupBy("mark", "before", "inside", "after").agg(F.max("secret").alias("secret")), "windows")
    parts = [
        each.where(F.col("secret") == secret).orderBy("mark", "before", "inside", "after").limit(number).collect()
        for secret, number in most.items()
    ]
    drop_staged(each)
    secrets, others = ([(row["before"], row["inside"], row["after"]) for row in part] for part in parts)
    return secrets, others


def _drawn(random: np.random.Generator, alphabet: str, size: int) -> str:
    return "".join(random.choice(list(alphabet), size))


def _key(random: np.random.Generator) -> str:
    """A random key. Short ones have digits among their letters, as generators of keys see to."""
    while True:
        key = _drawn(random, _ALPHABETS[random.integers(len(_ALPHABETS))], random.integers(LEAST_ASSIGN, INSIDE + 1))
        if random.random() < 0.4:
            key = key[: random.integers(LEAST_ASSIGN, 21)]
        if len(key) > 20 or (any(map(str.isdigit, key)) and any(map(str.isalpha, key))):
            return key


def _decoy(random: np.random.Generator, words: list[str], names: bool = False) -> str:
    """A run that is no secret though it is no word either; of the ``names`` of programs, too."""

    def digits(size: int) -> str:
        return _drawn(random, _DIGITS, size)

    def below(most: int) -> str:
        return str(random.integers(most))

    def word() -> str:
        return words[random.integers(len(words))]

    some = [word() for _ in range(random.integers(2, 4))]
    date = f"20{digits(2)}-{random.integers(1, 13):02d}-{random.integers(1, 29):02d}"
    hexed = [_drawn(random, _ALPHABETS[0], size) for size in (8, 4, 4, 4, 12)]
    kinds = (
        lambda: ".".join(below(256) for _ in range(4)),
        lambda: digits(random.integers(8, 20)),
        lambda: "-".join(digits(4) for _ in range(4)),
        lambda: f"+{digits(2)}-{digits(3)}-{digits(random.integers(3, 8))}",
        lambda: f"{date}T{digits(2)}",
        lambda: f"{date.replace('-', '')}_{digits(6)}",
        lambda: date,
        lambda: "-".join(hexed),
        lambda: _drawn(random, _UPPER, 2) + digits(random.integers(16, 23)),
        lambda: f"IMG_{date.replace('-', '')}_{digits(6)}.jpg",
        lambda: f"{word()}_{word()}_v{below(9)}.{('pdf', 'txt', 'docx', 'csv', 'html')[random.integers(5)]}",
        lambda: f"{word()}{below(20)}.{word()}.{('com', 'org', 'net', 'de')[random.integers(4)]}",
        lambda: f"v{below(9)}.{below(30)}.{below(30)}-{('beta', 'rc', 'alpha')[random.integers(3)]}{below(9)}",
        lambda: some[0] + "".join(map(str.capitalize, some[1:])),
        lambda: "_".join(some),
        lambda: "-".join(some),
        lambda: "_".join(some).upper(),
        lambda: "/".join(some),
        lambda: f"{digits(3)}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
        lambda: f"{word().capitalize()}.{below(200)}",
        lambda: f"{word()}{below(100)}",
        lambda: word().upper() + word(),
        lambda: word().upper() + ".!"[random.integers(2)],
        lambda: word().upper(),
        lambda: "".join(some),
    )
    if names:
        kinds += tuple(
            lambda made=made: made(random.choice(_NAMES, random.integers(2, 5)).tolist())
            for made in (lambda some: "_".join(some).upper(), "/".join, "_".join)
        )
    while len(run := kinds[random.integers(len(kinds))]()) < LEAST_ASSIGN:
        pass
    return run[:INSIDE]


def train(findings: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> Network | None:
    """Train, calibrate and set the threshold on a bounded sample of findings; None if too little is to be learned."""
    read = findings.select(F.col("candidates").alias("_read")).repartition(_READERS)
    return learn(*_sampled(read, _of_findings, sample), recall)


def _words(others: list[Window]) -> list[str]:
    return [window[1].strip(".=").lower() for window in others if window[1].strip(".=").isalpha()] or ["something"]


def _planted(
    others: list[Window], number: int, random: np.random.Generator, names: bool = False
) -> tuple[list[Window], list[Window]]:
    """Random keys and decoys in the surroundings of others."""
    words = _words(others)
    places = [others[(7 * at + 3) % len(others)] for at in range(number)]
    keys = [(before, _key(random), after) for before, _, after in places]
    return keys, [(before, _decoy(random, words, names), after) for before, _, after in places]


def learn(secrets: list[Window], others: list[Window], recall: float = RECALL, planted: int = PLANTED) -> Network | None:
    """Train on windows that are secrets and others, on planted keys and decoys; None with fewer than ten others."""
    if len(others) < 10:
        return None
    random = np.random.default_rng(42)
    moved = [_moved(secret, others, number) for number, secret in enumerate(secrets)]
    keys, decoys = _planted(others, planted, random)
    groups = (secrets, moved, keys, others, decoys)
    ids, inside = windows([window for group in groups for window in group])
    group = np.repeat(np.arange(5), [len(part) for part in groups])
    target = (group < 3).astype(float)
    held = np.concatenate([np.arange(len(part)) % 5 == 0 for part in groups])
    size = _REACH * (_EMBEDDING + 1)
    network = Network(
        random.normal(0, 0.5, (_CLASSES, _EMBEDDING)),
        random.normal(0, size**-0.5, (size, _FILTERS)),
        np.zeros(_FILTERS),
        np.append(random.normal(0, 0.1, 2 * _FILTERS), 0.0),
    )
    steps = _Steps(network.state)
    plain = np.flatnonzero(group == 3)
    late = plain[len(secrets) + planted :]
    rows = np.setdiff1d(np.flatnonzero(~held), late)
    for epoch in range(2 * _EPOCHS):
        if epoch == _EPOCHS:
            # Of the others not seen so far, those that look most like secrets.
            unseen = late[~held[late]]
            chance = network.forward_all(ids[unseen], inside[unseen])
            rows = np.append(rows, unseen[np.argsort(-chance, kind="stable")[:planted]])
        random.shuffle(rows)
        rate = _RATE * (1 - epoch / (2 * _EPOCHS))
        for at in range(0, len(rows), _BATCH):
            own = rows[at : at + _BATCH]
            steps.step(network.gradients(ids[own], inside[own], target[own]), rate)
    logit = network.forward_all(ids[held], inside[held])
    long_enough = inside[held].sum(axis=1) >= SURE
    _decide(network, logit, group[held], np.ones(len(logit)), long_enough, recall)
    return network


def _moved(secret: Window, others: list[Window], number: int) -> Window:
    before, _, after = others[(7 * number + 3) % len(others)]
    return before, secret[1], after


def _mark(window: Window) -> bytes:
    return hashlib.blake2b("\0".join(window).encode(), digest_size=8).digest()


def _learners(docs: DataFrame, text: str, held: bool) -> DataFrame:
    """The texts (``_read``) of the fifth that is held out of training, or of the others; equal texts are in one part."""
    value = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_read"))
    part = F.crc32(F.col("_read").cast("binary")) % 5 == 0
    return value.where(part if held else ~part)


def fit(docs: DataFrame, text: str = "text", recall: float = RECALL) -> Network | None:
    """The network, its calibration and its threshold from the findings of all texts; None if too little is to be learned."""
    learners = _learners(docs, text, False)
    secrets, others = _sampled(sampled_texts(learners, "_read"), _of_texts, SAMPLE)
    if len(others) < 10:
        # Candidates are rare, so all texts are read for them.
        secrets, others = _sampled(learners.repartition(_READERS), _of_texts, SAMPLE)
    network = learn(secrets, others, recall)
    if network is None:
        return None
    keys, decoys = _planted(others, _POOL, np.random.default_rng(43), names=True)
    taught = [[window for at, window in enumerate(part) if at % 5] for part in (keys, decoys)]
    schema = "mark binary, before string, inside string, after string, secret boolean"
    first = [(_mark(window), *window, secret) for part, secret in ((secrets, True), (others, False)) for window in part]
    hard = docs.sparkSession.createDataFrame(first, schema)
    for rates in _RATES:
        before, hard = hard, _hard(learners, network, hard)
        drop_staged(before)
        for rate in rates:
            network = _refined(hard, network, others, *taught, rate)
    drop_staged(hard)
    _settle(network, _learners(docs, text, True), others, keys[::5], decoys[::5], recall)
    return network


def _hard(learners: DataFrame, network: Network, before: DataFrame) -> DataFrame:
    """The windows of all texts that training can learn from, each once, and those known before.

    These are all secrets, and the others that the network does not put below ``_COLLECTED``. At any other the loss is
    flat, so it would add nothing.
    """
    shared = learners.sparkSession.sparkContext.broadcast(network)
    least = np.log(_COLLECTED / (1 - _COLLECTED))
    names = ("mark", "before", "inside", "after", "secret")

    def process(block: pa.RecordBatch) -> dict[str, list]:
        texts = texts_of(block, "_read")
        known = [
            [own for own in some if own[2] is not None] for _, some in candidates_of_all(texts, labelled=False)
        ]
        logits = shared.value.logits_all(texts, [[own[:2] for own in some] for some in known])
        found = []
        for value, some, own in zip(texts, known, logits, strict=True):
            for at in np.flatnonzero((own > least) | np.array([secret for _, _, secret in some], bool)).tolist():
                start, end, secret = some[at]
                if secret or not secret_like(value[start:end]):
                    found += [(_mark(window), *window, secret) for window in _cut(value, start, end, secret)]
        return dict(zip(names, zip(*found, strict=True), strict=True)) if found else {name: [] for name in names}

    each = map_blocks(learners, "_read", ddl(before, *names), process).union(before.select(*names))
    return staged(each.groupBy(*names[:-1]).agg(F.max("secret").alias("secret")), "hard")


def _refined(
    hard: DataFrame, network: Network, others: list[Window], keys: list[Window], decoys: list[Window], rate: float
) -> Network:
    """The mean of networks that each learn from one of ``_READERS`` parts of the windows, those of like hashes."""
    shared = hard.sparkSession.sparkContext.broadcast((network, others, *(windows(part) for part in (keys, decoys))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, others, keys, decoys = shared.value
        network = Network(*(part.astype(np.float32) for part in network.state))
        steps, random, rows, kept = _Steps(network.state), np.random.default_rng(44), 0, []

        def learn_from(some: list[dict]) -> None:
            own = [((row["before"], row["inside"], row["after"]), row["secret"]) for row in some]
            own += [
                (_moved(window, others, int.from_bytes(row["mark"][:6])), True)
                for (window, secret), row in zip(own, some, strict=True)
                if secret
            ]
            planted = [random.integers(len(part[0]), size=_BATCH // 2) for part in (keys, decoys)]
            drawn = [(part[0][at], part[1][at]) for part, at in zip((keys, decoys), planted, strict=True)]
            drawn.append(windows([window for window, _ in own]))
            target = np.repeat([1.0, 0.0], _BATCH // 2).tolist() + [float(secret) for _, secret in own]
            ids, inside = (np.concatenate(part) for part in zip(*drawn, strict=True))
            steps.step(network.gradients(ids, inside, np.array(target), FLAT), rate)

        every = (row for batch in batches for row in batch.to_pylist())
        while some := list(islice(every, _BATCH)):
            rows += len(some)
            learn_from(some)
            if steps.number <= _LEAST_STEPS:
                kept.append(some)
        for at in range(steps.number, _LEAST_STEPS if kept else 0):  # few windows: again from the first
            learn_from(kept[at % len(kept)])
        flat = np.concatenate([part.ravel() for part in network.state])
        part = [TaskContext.get().partitionId()]
        yield pa.RecordBatch.from_pydict({"part": part, "rows": [rows], "state": [flat.tolist()]})

    parts = hard.repartition(_READERS, "mark").sortWithinPartitions("mark", "before", "inside", "after")
    learned = sorted(parts.mapInArrow(run, "part long, rows long, state array<double>").collect())
    mean = np.average([row["state"] for row in learned], axis=0, weights=[row["rows"] for row in learned])
    cuts = np.cumsum([part.size for part in network.state])[:-1]
    return Network(*(part.reshape(old.shape) for part, old in zip(np.split(mean, cuts), network.state, strict=True)))


def _settle(
    network: Network, held: DataFrame, others: list[Window], keys: list[Window], decoys: list[Window], recall: float
) -> None:
    """Calibrate the network and set its threshold by all findings of the held texts, and held keys and decoys.

    Outputs are counted in steps of 1 / ``_STEPS``. The findings weigh as many as a sample at most, so that the keys and
    decoys count beside them at any size; all of them are counted.
    """
    shared = held.sparkSession.sparkContext.broadcast((network, others))

    def process(block: pa.RecordBatch) -> dict[str, list]:
        network, others = shared.value
        texts = texts_of(block, "_read")
        known = [[own for own in some if own[2] is not None] for _, some in candidates_of_all(texts)]
        logits = network.logits_all(texts, [[own[:2] for own in some] for some in known])
        groups = [0 if secret else 3 for some in known for _, _, secret in some]
        secrets = [
            window
            for value, some in zip(texts, known, strict=True)
            for start, end, secret in some
            if secret
            for window in _cut(value, start, end, True)
        ]
        moved = windows([_moved(window, others, int.from_bytes(_mark(window)[:6])) for window in secrets])
        every = np.concatenate([*logits, network.forward_all(*moved)])
        place = np.floor(np.clip(every, -40, 40) * _STEPS).astype(int).tolist()
        counts = Counter(zip(groups + [1] * len(secrets), place, strict=True))
        return {"kind": [at for at, _ in counts], "place": [at for _, at in counts], "n": list(counts.values())}

    counted = map_blocks(held, "_read", "kind int, place int, n long", process)
    rows = sorted(counted.groupBy("kind", "place").agg(F.sum("n").alias("n")).collect())
    group = np.array([row["kind"] for row in rows], int)
    logit = np.array([row["place"] for row in rows], float) / _STEPS
    weight = np.array([row["n"] for row in rows], float)
    for kind, most in ((0, SAMPLE), (1, SAMPLE), (3, OTHERS)):
        weight[group == kind] *= min(1.0, most / 5 / max(1.0, weight[group == kind].sum()))
    ids, inside = windows([*keys, *decoys])
    logit = np.concatenate([logit, network.forward_all(ids, inside)])
    group = np.concatenate([group, np.repeat([2, 4], [len(keys), len(decoys)])])
    weight = np.concatenate([weight, np.full(len(ids), PLANTED / 5 / max(1, len(keys)))])
    long_enough = np.concatenate([np.ones(len(rows), bool), inside.sum(axis=1) >= SURE])
    _decide(network, logit, group, weight, long_enough, recall)


def _decide(
    network: Network, logit: np.ndarray, group: np.ndarray, weight: np.ndarray, long_enough: np.ndarray, recall: float
) -> None:
    """Calibrate, then set the highest threshold with the wanted recall, higher if too little of what it finds are secrets.

    The rules' secrets (groups 0 and 1) and the planted keys (2) must both be found; decoys and others (3 and 4) count
    alike against them.
    """
    network.slope, network.shift = _calibrated(logit, (group < 3).astype(float), weight)
    found = network.calibrated(logit)
    kinds = [(found[own], weight[own]) for own in (group < 2, (group == 2) & long_enough) if own.any()]
    if not kinds:
        network.threshold = 2.0
        return
    lowest, highest = (
        min(_quantile(*part, 1 - share) for part in kinds) for share in (recall, min(recall, LEAST_RECALL))
    )
    against = group >= 3
    for threshold in np.unique(np.append(found[(found > lowest) & (found < highest)], [lowest, highest])):
        true = sum(own[part >= threshold].sum() for part, own in kinds)
        if true >= PRECISION * (true + weight[against & (found >= threshold)].sum()):
            break
    # Less what single precision may differ by.
    network.threshold = float(threshold) - 1e-6


def _quantile(values: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The greatest value with at most this share of the weight below it."""
    order = np.argsort(values, kind="stable")
    below = np.cumsum(weight[order]) - weight[order]
    return float(values[order[np.flatnonzero(below <= share * weight.sum() + 1e-9)[-1]]])


def _calibrated(logit: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits best, by Newton steps with a small penalty."""
    basis = np.column_stack([logit, np.ones(len(logit))])
    state = np.array([1.0, 0.0])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(basis @ state, -40, 40)))
        gradient = basis.T @ (weight * (chance - target)) + 0.1 * (state - [1.0, 0.0])
        curve = (basis * (weight * chance * (1 - chance))[:, None]).T @ basis + 0.1 * np.eye(2)
        state = state - np.linalg.solve(curve, gradient)
    return max(1e-3, float(state[0])), float(state[1])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Network | None = None) -> DataFrame:
    """Per row ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` of the rules' spans, and all ``spans``.

    Without a trained ``model``, one is trained on the findings of all these rows.

    A span is written ``kind:start:end`` in code points, the end exclusive; spans are in order of start, then kind.
    """
    if model is None:
        model = fit(docs, text)
    network = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def process(block: pa.RecordBatch) -> dict[str, list]:
        model = network.value
        columns = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added")}
        texts = texts_of(block, text)
        found = candidates_of_all(texts, labelled=False)
        open_ = [[(start, end) for start, end, secret in own if not secret] for _, own in found]
        chances = model.score_all(texts, open_) if model else [np.zeros(len(own)) for own in open_]
        for (spans, _), own, chance in zip(found, open_, chances, strict=True):
            base = [(start, kind, end) for kind, start, end in spans]
            likely = np.flatnonzero(chance >= model.threshold).tolist() if model else []
            added = [(own[at][0], KINDS.index("cnn"), own[at][1]) for at in likely]
            for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                columns[name].append(sum(span[1] == kind for span in base))
            columns["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
            columns["spans"].append(_written(sorted(base + added)))
            columns["n_added"].append(len(added))
        return columns | {key: block.column(block.schema.get_field_index(key))}

    schema = f"{ddl(docs, key)}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"
    return map_blocks(docs.select(key, text), text, schema, process)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
