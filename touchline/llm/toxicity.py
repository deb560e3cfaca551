"""Toxicity score: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased, white space becomes one kind of space, and n-grams of code points (5 to 8) are hashed. A feature's
value is how dense its n-gram is in the text: count / (count + characters / DENSITY), so that a chance hit in a long text
weighs little. A text of more than ``WINDOW`` characters is scored in windows of that size, each half over the next, and
has the highest score of them, so that what surrounds a toxic passage does not hide it; training takes the density over
the whole text, which a label speaks of. On labelled texts, values are summed by class; the log ratio of the two classes scales the feature, and
the features that separate the classes best are kept. Logistic regression on the scaled features is fitted to the same
texts.

The labelled sample is bounded: ``SAMPLE_ROWS`` different texts, those with the smallest hashes, so equal texts count
once and a text with many copies weighs no more than another. A text with labels that disagree has the majority's.
The model is at most ``FEATURES`` weights and is all that is broadcast; scoring reads whole texts block by block.

Null and empty texts get the score of a text without any known n-gram. Rows without a label are not learned from. If
the sample has only one class, or is empty, all texts get that class's share of it (0.5 for none, smoothed). Repeated
rows get equal scores; other columns, whatever their names, pass through or are left out as asked for. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import blocks, ddl, drop_staged, map_blocks, staged, texts_of

SIZES = (5, 6, 7, 8)
#: A text of so many characters that holds an n-gram once has the value 1/2.
DENSITY = 1000
#: Characters that are scored together.
WINDOW = 1536
HASH_BITS = 20
#: Labelled texts used for training, at most.
SAMPLE_ROWS = 6_000
#: n-grams kept, at most; each must weigh as much as so many texts of one class.
FEATURES = 4096
LEAST_TEXTS = 3
#: Weight of the penalty on squared weights, per text.
PENALTY = 1e-3
_STEPS = 400
#: Characters hashed at once; some 150 times as many bytes are held meanwhile.
_BLOCK = 1 << 17


@dataclass
class Model:
    """Weights by hashed n-gram; ``place`` maps a hash to its weight's number or -1."""

    place: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each text the highest score of its windows."""
        if not texts:
            return np.zeros(0)
        parts, first = [], []
        for text in texts:
            first.append(len(parts))
            parts += windows(text)
        rows, features, values = densities(parts, self.place)
        total = np.bincount(rows, weights=self.weights[features] * values, minlength=len(parts)) + self.bias
        return np.maximum.reduceat(1.0 / (1.0 + np.exp(-np.clip(total, -50, 50))), first)


def windows(text: str) -> list[str]:
    """A text, or if it is long its parts of ``WINDOW`` characters, each half over the next, to its end."""
    if len(text) <= WINDOW:
        return [text]
    last = len(text) - WINDOW
    return [text[at : at + WINDOW] for at in [*range(0, last, WINDOW // 2), last]]


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash for the n-gram of code points that begins at each place."""
    gram = np.zeros(len(data) - size + 1, np.uint64)
    for offset in range(size):
        gram *= np.uint64(0x9E3779B97F4A7C15)
        gram += data[offset : len(data) - size + 1 + offset]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9 + 2 * size)
    return (gram >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def densities(texts: list[str], place: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each feature that a text has, once: the text's number, the feature's, its value. Without ``place``, all hashes.

    Values are multiples of 1/1024, so that sums of them do not depend on their order.
    """
    none = np.zeros(0, np.int64)
    rows, features, values = [none], [none], [np.zeros(0)]
    encoded = [f" {text.lower()} " for text in texts]
    start = 0
    while start < len(encoded):
        end, size = start + 1, len(encoded[start])
        while end < len(encoded) and size + len(encoded[end]) <= _BLOCK:
            size += len(encoded[end])
            end += 1
        data = np.frombuffer("".join(encoded[start:end]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        data[(data >= 9) & (data <= 13)] = 32
        ends = np.cumsum([len(value) for value in encoded[start:end]])
        found = []
        for width in SIZES:
            if len(data) < width:
                continue
            hashes = _hashes(data, width)
            if place is None:
                at, feature = np.arange(len(hashes)), hashes
            else:
                numbers = place[hashes]
                at = np.flatnonzero(numbers >= 0)
                feature = numbers[at].astype(np.int64)
            text = np.searchsorted(ends, at, side="right")
            inside = at + width <= ends[text]
            found.append((text[inside] + start) << 32 | feature[inside])
        pairs, counts = np.unique(np.concatenate(found) if found else none, return_counts=True)
        length = np.array([len(value) for value in encoded[start:end]])[(pairs >> 32) - start]
        values.append(np.ceil(1024 * counts / (counts + length / DENSITY)) / 1024)
        rows.append(pairs >> 32)
        features.append(pairs & 0xFFFFFFFF)
        start = end
    return np.concatenate(rows), np.concatenate(features), np.concatenate(values)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Up to ``rows`` different labelled texts (``_text``) with the mean of their labels (``_label``)."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("_id")).agg(F.avg(F.col(label).cast("double")).alias("_label"))
    value = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.select(F.col(key).alias("_id"), F.xxhash64(value).alias("_hash")).join(known, "_id")
    chosen = (
        hashed.groupBy("_hash").agg(F.avg("_label").alias("_label"), F.min("_id").alias("_id"))
        # The order of a second hash is random to the first, which other operators deal rows by.
        .orderBy(F.xxhash64("_hash"), "_hash")
        .limit(rows)
    )
    chosen = staged(chosen, "chosen")  # three numbers for each of at most ``rows`` texts
    return (
        docs.select(F.col(key).alias("_id"), value.alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .where(F.xxhash64("_text") == F.col("_hash"))
        .select("_id", "_text", "_label")
        .dropDuplicates(["_id"])
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """Fit the model on a bounded sample of labelled rows."""
    sample = staged(labelled_sample(docs, labels, label, key, text).repartition(8), "sample")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of a task by class, one number for each hash, so that a task's memory does not follow its texts.
        yes, no = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
        for block in blocks(batches, "_text", _BLOCK):
            positive = np.array(block.column(block.schema.get_field_index("_label")).to_pylist()) >= 0.5
            rows, features, values = densities(texts_of(block, "_text"), None)
            for sums, own in ((yes, positive[rows]), (no, ~positive[rows])):
                sums += np.bincount(features[own], weights=values[own], minlength=len(sums))
        found = np.flatnonzero(yes + no)
        for part in np.array_split(found, len(found) // 50_000 + 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(yes[part]), pa.array(no[part])], ["feature", "yes", "no"]
            )

    by_feature = sample.mapInArrow(counts, "feature long, yes double, no double")
    by_feature = by_feature.groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    positives, total = sample.agg(F.sum((F.col("_label") >= 0.5).cast("long")), F.count("*")).first()
    positives, negatives = positives or 0, total - (positives or 0)
    place = np.full(1 << HASH_BITS, -1, np.int32)
    bias = float(np.log((positives + 0.5) / (negatives + 0.5)))
    if not positives or not negatives:
        drop_staged(sample)
        return Model(place, np.zeros(1), bias)
    # How far the shares of the two classes stand apart, in standard errors under equal shares.
    share = (F.col("yes") + F.col("no")) / F.lit(float(total))
    error = F.sqrt(share * (1 - share) * F.lit(1 / positives + 1 / negatives) + 1e-12)
    apart = F.abs(F.col("yes") / F.lit(float(positives)) - F.col("no") / F.lit(float(negatives))) / error
    best = (
        by_feature.where(F.greatest("yes", "no") >= LEAST_TEXTS)
        .withColumn("apart", F.round(apart, 6))
        .where("apart >= 3.5")
        .orderBy(F.desc("apart"), "feature")
        .limit(FEATURES)
        .collect()
    )
    ratio = np.zeros(max(1, len(best)))
    for number, row in enumerate(best):
        place[row["feature"]] = number
        ratio[number] = np.log((row["yes"] + 1) / (positives + 2)) - np.log((row["no"] + 1) / (negatives + 2))

    def rows_with_features(block: pa.RecordBatch) -> dict[str, list]:
        texts = texts_of(block, "_text")
        rows, features, values = densities(texts, place)
        cuts = np.searchsorted(rows, np.arange(1, len(texts)))
        lists = {name: [part.tobytes() for part in np.split(column, cuts)] for name, column in
                 (("features", features.astype(np.int32)), ("values", values))}
        return lists | {"_label": block.column(block.schema.get_field_index("_label"))}

    # At most SAMPLE_ROWS lists of at most FEATURES numbers, as they lie in memory.
    listed = "features binary, `values` binary, _label double"
    rows = map_blocks(sample, "_text", listed, rows_with_features).collect()
    drop_staged(sample)
    target = np.array([row["_label"] >= 0.5 for row in rows], float)
    feature = np.frombuffer(b"".join(row["features"] for row in rows), np.int32)
    value = np.frombuffer(b"".join(row["values"] for row in rows), float)
    owner = np.repeat(np.arange(len(rows)), [len(row["values"]) // value.itemsize for row in rows])
    weights, bias = fit(owner, feature, value * ratio[feature], target, len(ratio))
    return Model(place, weights * ratio, bias)


def fit(
    owner: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, size: int
) -> tuple[np.ndarray, float]:
    """Logistic regression on the features of rows (``owner``, ``feature``, ``value``) by accelerated gradient steps."""
    count = len(target)
    # A row's squared length bounds the curvature.
    lengths = np.bincount(owner, weights=value**2, minlength=count) + 1
    step = 1 / (0.25 * max(1.0, float(np.quantile(lengths, 0.99))) + PENALTY)
    weights, bias, moved, moved_bias = np.zeros(size), 0.0, np.zeros(size), 0.0
    for number in range(_STEPS):
        total = np.bincount(owner, weights=value * moved[feature], minlength=count) + moved_bias
        error = 1 / (1 + np.exp(-np.clip(total, -50, 50))) - target
        gradient = np.bincount(feature, weights=value * error[owner], minlength=size) / count + PENALTY * moved
        new, new_bias = moved - step * gradient, moved_bias - step * error.mean() * 10
        pull = number / (number + 3)
        moved, moved_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, float(bias)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``score``, from 0 to 1; higher means toxic likelier."""
    keep = keep or [name for name in docs.columns if name != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes for each of 2 ** HASH_BITS hashes

    def process(block: pa.RecordBatch) -> dict[str, list]:
        columns = {name: block.column(block.schema.get_field_index(name)) for name in keep}
        return columns | {"score": shared.value.scores(texts_of(block, text))}

    return map_blocks(
        docs.select(*dict.fromkeys([*keep, text])), text, f"{ddl(docs, *keep)}, score double", process
    )


def held_out(key: str = "doc_id"):
    """Whether a row's label is kept back for testing: the CRC-32 of its id as text is a multiple of 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``held_out``, ``score`` and ``predicted`` for each row; learned from labelled rows that are not held out."""
    model = train(docs, labels.where(~F.coalesce(held_out(key), F.lit(True))), "toxic", key, text)
    return score(docs, model, text, [key]).select(
        key,
        F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
