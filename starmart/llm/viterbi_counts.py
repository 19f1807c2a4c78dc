"""Token counts under a unigram vocabulary: Viterbi that keeps only score and count.

An Aho-Corasick automaton names the vocabulary pieces that end at each letter; the best
score and the number of pieces of every prefix are kept, no segmentation is.  Ties go as in
the tokenizer: of equal scores the piece that starts first stays.  A letter without a piece
of its own may be unknown, at the lowest score less ten, and counts as one piece for each of
its bytes (byte fallback).

Text is prepared as the tokenizer does: a space is put before it and spaces become U+2581.
No piece holds U+2581 behind another letter, and a letter that no piece holds stands alone,
so a text is cut at both and each different chunk is solved once; the chunks remembered in a
worker are bounded in number.

Defined results: null and empty texts count zero pieces with score zero.  Repeated rows give
a row each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.common import Remembered, each_batch, only, texts

REMEMBERED = 400_000  # chunks kept in a worker
SPACE_MARK = "▁"
CHUNKS = re.compile(" *[^ ]+| +")
CHUNKS_AND_NEWLINES = re.compile(" *[^ \n]+| +|\n")
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer


class UnigramCounter:
    """``vocabulary``: (piece, score) of the ordinary pieces, without control and byte pieces."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton, self.letters = ahocorasick.Automaton(), set()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                self.letters.update(piece)
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p, _ in vocabulary):
            raise ValueError("a piece reaches over a space")
        self.newline_alone = "\n" not in self.letters
        self.known: dict[str, tuple[int, float]] = Remembered(self.solve)

    def solve(self, chunk: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation."""
        chunk = chunk.replace(" ", SPACE_MARK)
        n = len(chunk)
        score: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        score[0] = 0.0
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(chunk):
            ending[end + 1].append(match)
        for end in range(1, n + 1):
            best, pieces, single = None, 0, False
            for length, own in ending[end]:  # longest first: the earliest start keeps a tie
                total = score[end - length] + own
                if best is None or total > best:
                    best, pieces = total, count[end - length] + 1
                single = single or length == 1
            if not single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    size = len(chunk[end - 1].encode("utf-8", "replace")) if self.byte_fallback else 1
                    best, pieces = total, count[end - 1] + size
            score[end], count[end] = best, pieces
        return count[n], score[n]

    def chunks(self, text: str) -> list[str]:
        """Parts that are segmented on their own, with plain spaces for the space mark."""
        marked = " " + text.replace(SPACE_MARK, " ")
        return (CHUNKS_AND_NEWLINES if self.newline_alone else CHUNKS).findall(marked)

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = list(map(self.known.__getitem__, self.chunks(text)))
        return sum([f[0] for f in found]), sum([f[1] for f in found])


@lru_cache(maxsize=1)
def counter(path: str) -> UnigramCounter:
    """The counter for a sentencepiece file's pieces and scores, one in each Python worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [
        i for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    return UnigramCounter([(model.id_to_piece(i), model.get_score(i)) for i in ordinary])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, score: pieces and summed score of the best segmentation of each whole text."""
    source = only(docs, doc_id=id_col, text=text_col)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(model_path).count
        found = [count(t) for t in texts(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())],
            names=["doc_id", "n_tokens", "score"],
        )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(each_batch(make), f"doc_id {kind}, n_tokens long, score double")
