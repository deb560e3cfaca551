"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a text's level s; ordered thresholds t1 < t2 < ... shared by all
texts cut it into grades: P(grade >= k) = sigmoid(s - t_k). So every rating, whatever its grade, teaches the same
weights. A text's expected grade is the sum of these probabilities, and the one for a chosen grade selects texts.

Features are hashed from the whole text: its words, the first and last characters of its words as classes (capital,
letter, digit, mark), and how often words and lines repeat. Values are square roots of shares, so length does not count.

The rated sample is bounded: ``SAMPLE_ROWS`` different texts, those with the smallest hashes. The model is
2 ** HASH_BITS weights and is all that is broadcast.

Null and empty texts have one feature of their own. Rows without a rating are not learned from. With no ratings all
weights are zero. Extra columns, whatever their names, are ignored; repeated rows get equal results. An empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ddl, drop_staged, map_blocks, staged, texts_of
from touchline.llm.toxicity import held_out, labelled_sample

HASH_BITS = 17
#: Rated texts used for training, at most.
SAMPLE_ROWS = 6_000
PENALTY = 1e-5
_STEPS = 300
_RATE = 0.05


def _classes() -> bytes:
    """For each byte, its class: capital A, letter a, digit 0, marks as they are."""
    table = bytearray(range(256))
    for byte in range(256):
        character = chr(byte)
        if byte >= 128 or character.islower():
            table[byte] = ord("a")
        elif character.isupper():
            table[byte] = ord("A")
        elif character.isdigit():
            table[byte] = ord("0")
    return bytes(table)


_CLASS = _classes()
#: Weights of the groups of features against each other.
_WORDS, _SHAPES, _REPEATS = 0.5, 2.0, 1.0


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values."""
    mask = (1 << HASH_BITS) - 1
    data = text.encode()
    words = data.split()
    if not words:
        return np.array([zlib.crc32(b"empty") & mask]), np.ones(1)
    counts = Counter(data.lower().split())
    hashed = [zlib.crc32(word) & mask for word in counts]
    number = len(words)
    values = _WORDS * np.sqrt(np.fromiter(counts.values(), float, len(counts)) / number)
    ends = Counter([(word[:1] + word[-2:]).translate(_CLASS) for word in words])
    shapes = [zlib.crc32(b"shape " + shape) & mask for shape in ends]
    shares = _SHAPES * np.sqrt(np.fromiter(ends.values(), float, len(ends)) / number)
    lines = [line for line in data.split(b"\n") if line.strip()]
    kinds = (
        f"words {number.bit_length()} {10 * len(counts) // number}",
        f"lines {10 * len(set(lines)) // len(lines)}",
        f"different {10 * len(counts) // number}",
    )
    repeats = [zlib.crc32(kind.encode()) & mask for kind in kinds]
    return np.array(hashed + shapes + repeats), np.concatenate([values, shares, np.full(len(kinds), _REPEATS)])


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, texts: list[str]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by text."""
        levels = np.array([self.weights[hashed] @ values for hashed, values in map(features, texts)])
        return _sigmoid(levels[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(owner: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Maximum likelihood with a squared penalty, by Adam steps over all rows."""
    count, size = len(grade), 1 << HASH_BITS
    # The last threshold distances are kept positive as exponentials.
    shares = np.clip(np.array([(grade >= k).mean() if count else 0.5 for k in range(1, grades)]), 0.02, 0.98)
    start = np.maximum.accumulate(-np.log(shares / (1 - shares)) + 1e-3 * np.arange(grades - 1))
    state = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, _STEPS + 1 if count else 0):
        weights, gaps = state[:size], np.exp(state[size + 1 :])
        thresholds = state[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        level = np.bincount(owner, weights=weights[feature] * value, minlength=count)
        over = np.column_stack([np.ones(count), _sigmoid(level[:, None] - thresholds), np.zeros(count)])
        rows = np.arange(count)
        low, high = over[rows, grade], over[rows, grade + 1]
        chance = np.maximum(low - high, 1e-9)
        slope_low, slope_high = low * (1 - low) / chance, high * (1 - high) / chance
        by_level = (slope_high - slope_low) / count
        gradient = np.zeros_like(state)
        gradient[:size] = np.bincount(feature, weights=value * by_level[owner], minlength=size) + PENALTY * weights
        by_threshold = np.zeros(grades - 1)
        np.add.at(by_threshold, grade[grade > 0] - 1, slope_low[grade > 0] / count)
        np.add.at(by_threshold, grade[grade < grades - 1], -slope_high[grade < grades - 1] / count)
        gradient[size] = by_threshold.sum()
        gradient[size + 1 :] = np.cumsum(by_threshold[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        state = state - _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    thresholds = state[size] + np.concatenate([[0.0], np.cumsum(np.exp(state[size + 1 :]))])
    return Model(state[:size], thresholds)


def train(
    docs: DataFrame, ratings: DataFrame, grades: int, grade: str = "grade", key: str = "doc_id", text: str = "text"
) -> Model:
    """Fit weights and thresholds for grades 0 to ``grades`` - 1 on a bounded sample of rated rows."""
    sample = staged(labelled_sample(docs, ratings, grade, key, text, SAMPLE_ROWS).repartition(8), "rated")

    def listed(block: pa.RecordBatch) -> dict[str, list]:
        found = [features(value) for value in texts_of(block, "_text")]
        return {
            "features": [hashed.astype(np.int32).tobytes() for hashed, _ in found],
            "values": [np.asarray(values, float).tobytes() for _, values in found],
            "grade": block.column(block.schema.get_field_index("_label")),
            "id": block.column(block.schema.get_field_index("_id")).cast(pa.string()),
        }

    # At most SAMPLE_ROWS lists of at most 2 ** HASH_BITS numbers, as they lie in memory; a text of a thousand words has
    # some hundreds.
    schema = "features binary, `values` binary, grade double, id string"
    rows = sorted(map_blocks(sample, "_text", schema, listed).collect(), key=lambda row: row["id"])
    drop_staged(sample)
    owner = np.repeat(np.arange(len(rows)), [len(row["features"]) // 4 for row in rows])
    join = lambda name, kind: np.frombuffer(b"".join(row[name] for row in rows), kind)
    grade_of = np.array([min(grades - 1, max(0, round(row["grade"]))) for row in rows], np.int64)
    return fit(owner, join("features", np.int32), join("values", float), grade_of, grades)


def grade_texts(
    docs: DataFrame, model: Model, tail: int = 1, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` with ``expected_grade`` and ``tail_probability``, that of grade ``tail`` or better."""
    keep = keep or [name for name in docs.columns if name not in ("expected_grade", "tail_probability")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def process(block: pa.RecordBatch) -> dict[str, list]:
        chances = shared.value.at_least(texts_of(block, text))
        columns = {name: block.column(block.schema.get_field_index(name)) for name in keep}
        return columns | {"expected_grade": chances.sum(axis=1), "tail_probability": chances[:, tail - 1]}

    schema = f"{ddl(docs, *keep)}, expected_grade double, tail_probability double"
    return map_blocks(docs.select(*dict.fromkeys([*keep, text])), text, schema, process)


def graded_labels(labels: DataFrame) -> DataFrame:
    """Ratings from the two labels: 0 poor, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality is not null").select("doc_id", grade.alias("grade"))


def quality_grades(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``held_out``, ``expected_grade``, ``tail_probability`` (good, toxic or not) and ``kept``.

    Learned from rated rows that are not held out.
    """
    ratings = graded_labels(labels).where(~F.coalesce(held_out(key), F.lit(True)))
    model = train(docs, ratings, 3, "grade", key, text)
    return grade_texts(docs, model, 1, text, [key]).select(
        key,
        F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= 0.5).alias("kept"),
    )
