"""Ids of whole texts from the tokenizers library, which is asked once for each different word.

A byte-level tokenizer without a normalizer never joins what stands on the two sides of a
single space between visible characters, so the ids of a text are those of its first word
and of each further word with its space.  The file's settings are read before this way is
taken; with any other settings the library gets the texts whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED_BYTES = 160 << 20  # of words and ids kept in a worker, in two halves, by a generous estimate
BLOCK_BYTES = 8 << 20
_PER_WORD = 200  # bytes of a dictionary entry and its two objects
MARKS = ".,;:!?"
_NOT_LATIN = "\u0250"
# Byte-level vocabularies spell visible Latin-1 bytes as themselves, the others in order from U+0100.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_SPACE = chr(_BYTE_LETTERS[0x20])
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def splits_at_spaces(settings: dict) -> bool:
    """Whether the tokenizer of this file cuts every text at lone spaces, for certain."""
    cut = settings.get("pre_tokenizer") or {}
    added = settings.get("added_tokens") or []
    return (
        settings.get("normalizer") is None
        and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        and not any(t["content"].isalpha() or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
    )


def _strings(words: pa.Array) -> list[str]:
    """As ``to_pylist``, several times faster."""
    return words.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """``encode(texts)``: the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            self.by_word = splits_at_spaces(json.load(file))
        self.words: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.held = 0

    def ask(self, texts: list[str]) -> list[bytes]:
        found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([4 * len(ids) for ids in found]).tolist()
        raw = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        return [raw[b:e] for b, e in zip([0, *ends], ends)]

    def _learn(self, words: pa.Array) -> list[bytes | None]:
        """Ids of different words, each asked without the marks at its end; None where a space is no sure border."""
        if self.held > REMEMBERED_BYTES // 2:
            self.older, self.words, self.held = self.words, {}, 0
        stems, words = _strings(pc.utf8_rtrim(words, MARKS)), _strings(words)
        # A run of marks after a letter is a piece of its own; elsewhere the word stays whole.
        stems = [s if s and s[-1].isalpha() else w for s, w in zip(stems, words)]
        gone = {s for s in stems if s not in self.words}
        back = {s: self.older[s] for s in gone if s in self.older}
        other = []
        for s in gone:
            if s in back:
                continue
            if s.isalpha() and max(s) < _NOT_LATIN:
                # Letters alone are one piece, which the library's model can be given at once.
                piece = s if s.isascii() else s.encode().decode("latin-1").translate(_BYTE_LETTERS)
                back[s] = array("I", [t.id for t in self.model.tokenize(_SPACE + piece)]).tobytes()
            else:
                other.append(s)
        for s, ids in zip(other, self.ask([f" {s}" for s in other])):
            # Next to other white space a space is no sure border.
            back[s] = None if not s or s[0].isspace() or s[-1].isspace() else ids
        self.words.update(back)
        self.held += sum(_PER_WORD + len(s) + len(x or b"") for s, x in back.items())
        ids = list(map(self.words.__getitem__, stems))
        marked = [k for k, (s, w) in enumerate(zip(stems, words)) if len(s) != len(w)]
        ends = [words[k][len(stems[k]) :] for k in marked]
        runs = list(set(ends))
        known = dict(zip(runs, self.ask(runs)))
        for k, end in zip(marked, ends):
            if ids[k] is not None:
                ids[k] += known[end]
        return ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Of string arrays without nulls; a block of ``BLOCK_BYTES`` (or one longer text) is worked on at a time."""
        if not self.by_word:
            return self.ask(_strings(texts))
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        out: list[bytes] = []
        while len(out) < len(texts):
            k = len(out)
            stop = np.searchsorted(ends, (ends[k - 1] if k else 0) + BLOCK_BYTES, "right")
            out += self._block(texts.slice(k, max(1, int(stop) - k)))
        return out

    def _block(self, texts: pa.Array) -> list[bytes]:
        cut = pc.split_pattern(texts, " ")
        begins = cut.offsets.to_numpy().astype(np.int64)[: len(texts) + 1]
        coded = cut.values.slice(begins[0], begins[-1] - begins[0]).dictionary_encode()
        begins -= begins[0]
        codes = coded.indices.to_numpy().copy()
        heads = begins[:-1]
        ids = self._learn(coded.dictionary)
        ids += self.ask(_strings(coded.dictionary.take(coded.indices.take(pa.array(heads)))))
        unsure = np.array([x is None for x in ids])
        codes[heads] = len(coded.dictionary) + np.arange(len(texts))
        table = np.frombuffer(b"".join(x or b"" for x in ids), "<u4")
        sizes = np.array([len(x or b"") // 4 for x in ids], np.int64)
        size = sizes[codes]
        stops = np.cumsum(size)
        at = np.ones(stops[-1], np.int64)  # steps from place to place in the table
        some = np.flatnonzero(size)
        firsts = (np.cumsum(sizes) - sizes)[codes[some]]
        at[(stops - size)[some]] = np.diff(firsts, prepend=0) - np.concatenate([[0], size[some][:-1] - 1])
        raw = table[np.cumsum(at, out=at)].tobytes()
        places = [0, *(4 * stops[begins[1:] - 1]).tolist()]
        again = np.logical_or.reduceat(unsure[codes], heads).tolist()
        return [
            self._pieces(texts[k].as_py()) if odd else raw[b:e]
            for k, (b, e, odd) in enumerate(zip(places, places[1:], again))
        ]

    def _pieces(self, text: str) -> bytes:
        """A text with runs of white space: cut at its sure borders only."""
        first, *rest = _BETWEEN.split(text)
        different = list(dict.fromkeys(rest))
        known = dict(zip(different, self.ask([f" {w}" for w in different])))
        return self.ask([first])[0] + b"".join(map(known.__getitem__, rest))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One encoder for all tasks of a Python worker."""
    return WordIds(path)
