"""Byte-pair encoding by dynamic programming over prefixes.

For every prefix of a piece exactly one token can be the last of its encoding.  The
suffix automaton of the vocabulary names the tokens that end at each byte; a candidate
stands if it may follow the last token of the prefix before it, which is a test on the two
tokens alone (would a merge across their border have come first?).  Following the stored
tokens back from the whole piece gives exactly the ids that merging in rank order gives.

The vocabulary is read once in each Python worker.  Encoded pieces are remembered in a
dictionary of bounded size that is emptied when full, so memory doesn't grow with the data.

Defined results: a null text is encoded as the empty one (no ids).  The added tokens of the
tokenizer file are cut out of the text first, as the library does.  Repeated rows give a
row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starmart.llm.common import Remembered, each_batch, only, texts

FEW_ROWS = 1000
REMEMBERED = 200_000  # pieces, and pairs of tokens, kept in a worker
FEW_REMEMBERED = 100_000  # where other stages share the worker
#: Fixed value: the cut of byte-level tokenizers, white space as Unicode defines it.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same cut for texts without the characters on which re and Unicode's classes differ; it is faster.
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNLIKE = regex.compile(r"[\p{Nl}\p{No}\x1c-\x1f]")
_NEVER = 1 << 62


def pieces(text: str) -> list[str]:
    return (PIECES if _UNLIKE.search(text) else PLAIN).findall(text)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + n): b for n, b in enumerate(others)}


class PrefixEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self.made, self.parts = [-1] * size, [(0, 0)] * size  # rank of the merge that makes a token, and its halves
        self.cross: dict[tuple[int, int], int] = {}
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            self.cross[pair] = rank
            if self.made[token] < 0:
                self.made[token], self.parts[token] = rank, pair
        self.stands: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i in vocab.values():
            if self.alone(i):  # others never appear in an encoding
                self.automaton.add_word(self.token_bytes[i].decode("latin-1"), (len(self.token_bytes[i]), i))
        self.automaton.make_automaton()
        self.decimals = [str(i) for i in range(size)]
        self.allowed: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = Remembered(self.encode_piece)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def compatible(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their joined bytes, given that each encodes its own.

        The merges of both are undone from the latest back; a merge across the border that
        ranks before the one undone would have taken place first.  Of equal ranks the left
        one comes first.  ``before`` leaves out merges of the two whole tokens from that rank on.
        """
        made, parts, cross = self.made, self.parts, self.cross
        while True:
            if cross.get((a, b), _NEVER) < before:
                return False
            if made[a] < 0 and made[b] < 0:
                return True
            if made[a] > made[b]:
                before, a = made[a], parts[a][1]
            else:
                before, b = made[b] + 1, parts[b][0]

    def alone(self, token: int) -> bool:
        """Whether merging makes this token from its own bytes."""
        found = self.stands.get(token)
        if found is None:
            rank, (left, right) = self.made[token], self.parts[token]
            found = rank < 0 or (self.alone(left) and self.alone(right) and self.compatible(left, right, rank))
            self.stands[token] = found
        return found

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one piece as little-endian 32-bit integers."""
        raw = piece.encode("utf-8", "replace").decode("latin-1")
        last: list[int] = [-1] * (len(raw) + 1)
        allowed, compatible = self.allowed, self.compatible
        for end, (length, token) in self.automaton.iter(raw):
            end += 1
            if last[end] >= 0:
                continue
            if end == length:
                last[end] = token
                continue
            pair = (last[end - length], token)
            may = allowed.get(pair)
            if may is None:
                may = allowed[pair] = compatible(*pair)
            if may:
                last[end] = token
        ids, at = [], len(raw)
        while at:
            ids.append(last[at])
            at -= len(self.token_bytes[last[at]])
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        known = self.known
        if self.cut is not None and self.cut.search(text):
            out = []
            for part in self.cut.split(text):
                if part in self.added:
                    out.append(np.array([self.added[part]], dtype="<u4").tobytes())
                else:
                    out.extend(map(known.__getitem__, pieces(part)))
            return b"".join(out)
        return b"".join(map(known.__getitem__, pieces(text)))

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace")

    def forget(self, most: int = REMEMBERED) -> None:
        if len(self.known) > most:
            self.known.clear()
        if len(self.allowed) > most:
            self.allowed.clear()


@lru_cache(maxsize=1)
def encoder(path: str) -> PrefixEncoder:
    """One encoder for all tasks of a Python worker."""
    return PrefixEncoder(path)


def encode_decode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False,
    remember: bool = True,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the token ids.

    Without ``remember`` a worker works on ``FEW_ROWS`` at a time, keeps ``FEW_REMEMBERED`` pieces and
    gives up its encoder after each task, so other stages of the same application get the memory.
    """
    source = only(docs, doc_id=id_col, text=text_col)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    most = REMEMBERED if remember else FEW_REMEMBERED

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(tokenizer_path)
        counts, sums, back, kept = [], [], [], []
        for text in texts(batch):
            raw = enc.encode(text)
            own = np.frombuffer(raw, dtype="<u4").tolist()
            counts.append(len(own))
            sums.append(hashlib.sha256(",".join([enc.decimals[i] for i in own]).encode()).hexdigest())
            back.append(hashlib.sha256(enc.decode(own).encode()).hexdigest())
            if ids:
                kept.append(raw)
            enc.forget(most)
        arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())]
        if ids:
            ends = pa.array(np.cumsum([0, *counts]), pa.int32())
            arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(kept), "<i4"))))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return source.mapInArrow(each_batch(make) if remember else each_batch(make, encoder.cache_clear, FEW_ROWS), schema)
