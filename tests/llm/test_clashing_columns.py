"""Extra columns, whatever their names, repeated rows and empty tables change no operator's results."""

import pytest
from llm_data import labels, nothing
from pyspark.sql import functions as F

from touchline.llm import bpe, ordinal_quality, toxicity
from touchline.llm.exact_dedup import exact_duplicates
from touchline.llm.queries import PATTERN, PIECES, RANKS
from touchline.llm.simhash import near_duplicates
from touchline.llm.token_counts import token_counts

#: Names that the operators give their results, or use inside.
NAMES = (
    "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "over_limit", "score", "predicted", "held_out",
    "expected_grade", "tail_probability", "fingerprint", "component_id", "kept", "keep_id", "group_size", "text_sha256",
    "_fp", "_row", "_first", "_hash", "_id", "_label", "_text", "copies",
)
ROWS = [(1, "one two three four five"), (2, "one two three four five"), (2, "one two three four five"), (3, None), (4, ""),
        (None, "AKIA and é words"), (5, "a" * 5000)]
KNOWN = [(1, 1, 1, 0.0), (2, 1, 0, 0.0), (4, 0, 0, 0.0), (5, 0, 1, 0.0)]

OPERATORS = {
    "bpe": lambda spark, docs: bpe.token_digests(docs, RANKS, PATTERN),
    "grades": lambda spark, docs: ordinal_quality.quality_grades(docs, labels(spark, KNOWN)),
    "near": lambda spark, docs: near_duplicates(docs),
    "counts": lambda spark, docs: token_counts(docs, PIECES),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, labels(spark, KNOWN)),
    "exact": lambda spark, docs: exact_duplicates(docs),
}


def _rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    clashing = docs.select("*", *[F.lit("other").alias(extra) for extra in NAMES])
    plain = OPERATORS[name](spark, docs)
    result = OPERATORS[name](spark, clashing)
    assert _rows(result.select(plain.columns)) == _rows(plain) and plain.count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_have_empty_results(spark, name):
    assert OPERATORS[name](spark, nothing(spark)).count() == 0
