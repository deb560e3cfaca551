"""Token counts for a piece vocabulary (BPE over characters with byte fallback), without encoding whole texts.

Two facts are proved once from the vocabulary, before any text is read:

* where texts can be cut. No entry holds a space mark after another character, so no merge crosses such a place, and
  a text may be counted word by word (a word keeps the space marks before it);
* which entries encode alone as one token: those that the merges, replayed from their own characters, bring back to
  the one symbol.

A word that is such an entry counts one. All other words are merged, each distinct one once per block
(``merges.replay``); characters without an entry count one token per UTF-8 byte. Counts of words are remembered in
bounded memory per Python worker.

Null texts count as empty; empty texts have no tokens. Control strings inside texts are ordinary characters. Texts of
any length are counted whole. Repeated rows get equal counts; extra columns, whatever their names, are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from touchline.llm.common import map_blocks, texts_of
from touchline.llm.merges import PairTable, replay

SPACE_MARK = "▁"
#: Words remembered per Python worker (about 120 bytes each).
REMEMBERED = 600_000
LONGEST_REMEMBERED = 128

_WORD = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")


class PieceVocabulary:
    """The entries of a piece model and what can be proved about them."""

    def __init__(self, pieces: list[str], scores: list[float]):
        """Normal entries only, with their scores: the higher score merges first."""
        crossing = [piece for piece in pieces if re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece)]
        if crossing:
            raise ValueError(f"entries join words, so texts cannot be cut at spaces: {crossing[:3]}")
        order = {score: number for number, score in enumerate(sorted(set(scores), reverse=True))}
        self.symbols = {piece: number for number, piece in enumerate(pieces)}
        self.table = PairTable(pieces, [order[score] for score in scores])
        counts = self._merged_counts(pieces)
        self.whole = {piece for piece, count in zip(pieces, counts, strict=True) if count == 1}
        self.known: dict[str, int] = {}

    @classmethod
    def from_file(cls, path: str) -> PieceVocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for probe in ("a  b\nÅﬁ", " x ", "　y\x00"):
            if model.normalize(probe) != SPACE_MARK + probe.replace(" ", SPACE_MARK):
                raise ValueError("the model rewrites texts before it splits them")
        normal = [
            number
            for number in range(model.vocab_size())
            if not (model.is_control(number) or model.is_unknown(number) or model.is_byte(number))
        ]
        return cls([model.id_to_piece(number) for number in normal], [model.get_score(number) for number in normal])

    def _merged_counts(self, words: list[str]) -> list[int]:
        """Tokens of each word by merging."""
        flat = "".join(words)
        codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        characters, place = np.unique(codes, return_inverse=True)
        symbols = np.array([self.symbols.get(chr(code), -1) for code in characters], np.int32)
        widths = np.array([len(chr(code).encode()) for code in characters], np.int64)
        lengths = np.array([len(word) for word in words], np.int64)
        merged, counts = replay(symbols[place], lengths, self.table)
        # A character without an entry stays one symbol and becomes as many tokens as it has bytes.
        extra = np.where(symbols[place] < 0, widths[place] - 1, 0)
        owner = np.repeat(np.arange(len(words)), lengths)
        return (counts + np.bincount(owner, weights=extra, minlength=len(words)).astype(np.int64)).tolist()

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        whole, known = self.whole, self.known
        totals, rest = [], []
        for text in texts:
            marked = SPACE_MARK + text.replace(" ", SPACE_MARK) if text else ""
            words = _WORD.findall(marked)
            others = [word for word in words if word not in whole]
            totals.append(len(words) - len(others))
            rest.append([known.get(word, word) for word in others])
        fresh = list(dict.fromkeys(word for words in rest for word in words if type(word) is str))
        found = dict(zip(fresh, self._merged_counts(fresh), strict=True)) if fresh else {}
        for number, words in enumerate(rest):
            totals[number] += sum([found[word] if type(word) is str else word for word in words])
        known.update((word, count) for word, count in found.items() if len(word) <= LONGEST_REMEMBERED)
        return totals


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: UTF-8 bytes, tokens, and whether there are more tokens than ``limit``."""

    # The proof takes seconds and its result a few megabytes, fixed by the vocabulary: made once, sent to all workers.
    vocabulary = docs.sparkSession.sparkContext.broadcast(PieceVocabulary.from_file(path))

    def process(block: pa.RecordBatch) -> dict[str, list]:
        texts = texts_of(block, text)
        counts = vocabulary.value.counts(texts)
        return {
            key: block.column(block.schema.get_field_index(key)),
            "n_bytes": [len(value.encode()) for value in texts],
            "n_tokens": counts,
            "over_limit": [count > limit for count in counts],
        }

    key_type = dict(docs.dtypes)[key]
    schema = f"`{key}` {key_type}, n_bytes long, n_tokens long, over_limit boolean"
    return map_blocks(docs.select(key, text), text, schema, process)
