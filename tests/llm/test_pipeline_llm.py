"""The pipeline against a plain version, stage by stage, and its stages on awkward rows."""

import base64

import public_tokenizers
import tiktoken
from llm_data import awkward, labels, nothing, sha
from test_dedup import plain_components, plain_fingerprint

import corpus_pipeline
from touchline.llm import source_mix, toxicity
from touchline.llm.common import BLOCK_BYTES, table
from touchline.llm.queries import RANKS

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_version(spark):
    docs = table(spark, SF, "documents")
    known = table(spark, SF, "labels").where(~toxicity.held_out())
    rows = [row for row in toxicity.score(docs, toxicity.train(docs, known)).collect() if row["score"] < 0.5]
    by_text = {}
    for row in sorted(rows, key=lambda row: row["doc_id"]):
        by_text[row["text"]] = row
    rows = sorted(by_text.values(), key=lambda row: row["doc_id"])
    roots = plain_components([plain_fingerprint(row["text"]) for row in rows])
    rows = [row for at, row in enumerate(rows) if roots[at] == at]
    left = spark.createDataFrame(rows, docs.schema.add("score", "double"))
    # The mixture itself is held against SQL elsewhere; here, that it is applied to what is left.
    copies = {row["doc_id"]: row["copies"] for row in source_mix.mix(source_mix.with_domain(left), source_mix.LEVELS).collect()}
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, open(RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for row in rows:
        ids = encoding.encode_ordinary(row["text"])
        expected += [(row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(row["text"]))] * copies[row["doc_id"]]
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_stages_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels(spark, [(7, 1, 1, 0.0), (9, 1, 0, 0.0)]))
    for docs in (awkward(spark), nothing(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, SF)
            assert result.dtypes == docs.dtypes
            assert result.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_stages_read_after_they_return_get_small_batches(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels(spark, [(7, 1, 1, 0.0), (9, 1, 0, 0.0)]))
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        for stage in (corpus_pipeline.reject_toxic, corpus_pipeline.encode_tokens):
            spark.conf.set(setting, str(64 << 20))
            stage(spark, awkward(spark), SF)
            assert spark.conf.get(setting) == str(BLOCK_BYTES)
    finally:
        spark.conf.set(setting, before)
