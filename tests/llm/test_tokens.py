"""Encoding and counting against the libraries, on awkward and on generated texts."""

import base64
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, TEXTS, awkward, nothing, sha

from touchline.llm import bpe
from touchline.llm.merges import PairTable, merge_one, replay
from touchline.llm.queries import PATTERN, PIECES, RANKS, op2_byte_bpe, op7_token_counts
from touchline.llm.token_counts import PieceVocabulary, token_counts


@pytest.fixture(scope="module")
def encoding():
    lines = map(bytes.split, open(RANKS, "rb"))
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return PieceVocabulary.from_file(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def digests(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(encoding.decode_bytes(ids))


def test_byte_bpe_equals_library(spark, encoding):
    for docs, query in ((spark.read.parquet(f"{SF}/documents.parquet"), True), (awkward(spark), False)):
        result = op2_byte_bpe(spark, SF) if query else bpe.token_digests(docs, RANKS, PATTERN)
        expected = sorted((str(row["doc_id"]), *digests(encoding, row["text"])) for row in docs.collect())
        assert sorted((str(row[0]), *row[1:]) for row in result.collect()) == expected
    assert bpe.token_digests(nothing(spark), RANKS, PATTERN).count() == 0


def test_encode_and_decode_round_trip(spark):
    encoded = bpe.encode(awkward(spark), RANKS, PATTERN)
    assert encoded.columns == [*awkward(spark).columns, "token_ids"]
    for row in bpe.decode(encoded, RANKS, PATTERN).collect():
        assert bytes(row["decoded"]).decode() == (row["text"] or "")


texts = st.one_of(
    st.text(alphabet="ab \n'st1!é▁日", max_size=60), st.text(max_size=40), st.text(alphabet="ab", min_size=50, max_size=200)
)


@settings(max_examples=150, deadline=None)
@given(value=texts)
def test_generated_texts(encoding, pieces, value):
    assert bpe.vocabulary(RANKS, PATTERN).encode([value]) == [encoding.encode_ordinary(value)]
    vocabulary, library = pieces
    assert vocabulary.counts([value]) == [len(library.encode(value))]


def test_piece_counts_equal_library(spark, pieces):
    library = pieces[1]
    for docs, query in ((spark.read.parquet(f"{SF}/documents.parquet"), True), (awkward(spark), False)):
        result = op7_token_counts(spark, SF) if query else token_counts(docs, PIECES)
        expected = []
        for row in docs.collect():
            text = row["text"] or ""
            count = len(library.encode(text))
            expected.append((str(row["doc_id"]), len(text.encode()), count, count > 4096))
        assert sorted((str(row[0]), *row[1:]) for row in result.collect()) == sorted(expected)
    assert token_counts(nothing(spark), PIECES).count() == 0


def test_whole_entries_are_proved(pieces):
    vocabulary, _ = pieces
    assert "▁the" in vocabulary.whole
    assert vocabulary.counts(["the the", ""]) == [2, 0]
    with pytest.raises(ValueError, match="join words"):
        PieceVocabulary(["a", "▁", "a▁"], [0.0, -1.0, -2.0])


def test_merges_that_turn_back_are_done_one_by_one():
    # "bc" has the lowest rank but appears only after "ab" could have merged with it: here ab -> abc is lower than ab.
    tokens = ["a", "b", "c", "d", "abc", "ab", "cd"]
    table = PairTable(tokens, list(range(7)))
    for word in ("abc", "abcabcd", "cdab", "aabbcc", "abababcd", ""):
        symbols = [tokens.index(letter) for letter in word]
        merged, counts = replay(np.array(symbols, np.int32), np.array([len(symbols)]), table)
        assert merged.tolist() == merge_one(symbols, table) and counts.tolist() == [len(merged)]


def test_known_words_are_forgotten_in_time(pieces, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    words = bpe.ByteBPE.from_file(RANKS, PATTERN)
    for text in [value or "" for value in TEXTS] * 2:
        [found] = words.look_up([words.pattern.findall(text)])
        assert b"".join(entry[1] for entry in found).decode() == text


def test_block_holds_no_pre_tokens_as_texts(spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(bpe, "map_blocks", lambda docs, text, schema, process: taken.update(process=process))
    bpe.token_digests(awkward(spark), RANKS, PATTERN)
    bpe.vocabulary(RANKS, PATTERN)
    texts = ["one two three " * 1000] * 100  # 400,000 pre-tokens of 50 bytes or more each
    block = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    try:
        counts = taken["process"](block)["n_tokens"]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(set(counts)) == 1
    assert peak < 16 << 20


def test_pre_tokens_are_merged_in_runs(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MERGED_BYTES", 8)
    words = bpe.ByteBPE.from_file(RANKS, PATTERN)
    texts = [value or "" for value in TEXTS]
    expected = [encoding.encode_ordinary(value) for value in texts]
    assert words.encode(texts) == expected
    found = words.look_up(words.pattern.findall(value) for value in texts)
    assert [",".join(entry[0] for entry in entries) for entries in found] == [",".join(map(str, ids)) for ids in expected]


def test_failed_block_leaves_no_unfilled_entries():
    words = bpe.ByteBPE.from_file(RANKS, PATTERN)
    with pytest.raises(UnicodeEncodeError):
        words.look_up([["ab", "\ud800"]])
    assert words.look_up([["ab"]])[0][0][1] == b"ab"
