"""Removal of word spans that appeared before, by matching statistics on suffix automata.

``fragments`` deals the passages that may repeat into shards by their content; each shard
is the reference of its own passages.  Its passages are read in the order of (document,
place): each is streamed through a suffix automaton of the earlier ones, which gives at
every word the length of the longest earlier match that ends there, and every window of 20
words inside a match goes.  Then the passage joins the automaton.  Passages meet only those
that have their anchor, so an automaton stays small.

Defined results: a null text has no words.  A null id is larger than any; rows that share an
id count as one document there.  Repeated rows give a row each: of equal texts the smallest
id keeps its words, and another id's row keeps none if it has 20 words.  An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import fragments
from starmart.llm.common import only

WORDS = 20
ANCHOR = 8
EMPTY = hashlib.sha256(b"").hexdigest()


class SuffixAutomaton:
    """Automaton of all substrings of the sequences added to it."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state that ``state`` reaches by ``symbol``, of exactly one symbol more."""
        reached = self.next[state][symbol]
        if self.length[state] + 1 == self.length[reached]:
            return reached
        clone = self._state(self.length[state] + 1, dict(self.next[reached]), self.link[reached])
        self.link[reached] = clone
        while state >= 0 and self.next[state].get(symbol) == reached:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            state = last
            while state >= 0 and symbol not in self.next[state]:
                self.next[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, symbol)
            last = new

    def matching(self, sequence: list[int]) -> list[int]:
        """Length of the longest added substring that ends at each place."""
        state, matched, out = 0, 0, []
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state, matched = self.next[state][symbol], matched + 1
            out.append(matched)
        return out


def judge(shard: fragments.Shard) -> list[np.ndarray]:
    """For every window of the shard whether an earlier passage has it; passages come in order."""
    ends = shard.ends.tolist()
    begins = [0, *ends[:-1]]
    out = [np.zeros(c, bool) for c in shard.counts.tolist()]
    order = np.argsort(shard.anchors, kind="stable")
    anchor, automaton = None, None
    words = shard.symbols.tolist()
    for k in order.tolist():
        sequence = words[begins[k] : ends[k]]
        if automaton is None or shard.anchors[k] != anchor:
            anchor, automaton = shard.anchors[k], SuffixAutomaton()
        else:
            out[k] = np.array(automaton.matching(sequence)[WORDS - 1 :]) >= WORDS
        automaton.add(sequence)
    return out


def symbols(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = [b.split() for b in bodies]
    digest = xxhash.xxh64_intdigest
    flat = np.array([digest(w) for ws in words for w in ws], dtype=np.uint64)
    return flat, np.cumsum([len(ws) for ws in words])


def finish(bodies: list[bytes], own: np.ndarray, ends: np.ndarray, earlier: np.ndarray) -> dict[str, list]:
    at = np.flatnonzero(earlier)
    cover = np.zeros(len(own) + WORDS + 1, np.int32)
    cover[at] += 1
    cover[at + WORDS] -= 1
    stays = np.cumsum(cover)[: len(own)] == 0
    out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": []}
    for body, a, b in zip(bodies, [0, *ends[:-1].tolist()], ends.tolist()):
        mask = stays[a:b]
        kept = [w for w, stay in zip(body.split(), mask.tolist()) if stay]
        out["n_words"].append(b - a)
        out["n_removed"].append(b - a - len(kept))
        out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


READING = fragments.Reading(symbols, WORDS, ANCHOR, within=True)


def remove_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    source = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "n_words long, n_removed long, kept_sha256 string"
    marks, firsts = fragments.over_documents(source, READING, "u8", judge, finish, schema)
    both = marks.join(firsts.withColumnRenamed("digest", "text_sha256"), "text_sha256")
    whole = ~F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_words") >= WORDS)
    return both.select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(EMPTY)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
