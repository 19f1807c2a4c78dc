"""Frequent phrases and how firmly their words belong together, by Rabin-Karp fingerprints.

1. Texts of a language are gathered into *packs*.  Prefix polynomials (modulo 2^64, in numpy)
   give the fingerprint of every word of a pack; words with one fingerprint are compared byte
   by byte.  A pack is kept as word numbers with its own dictionary, a fraction of its text.
2. For 1, 2 .. ``max_words`` words: a pack sends the different fingerprints of its n-grams, with
   counts, sorted and packed to six bytes each, dealt by fingerprint.  An n-gram goes only if
   both its (n-1)-grams were frequent.  Where the counts of a fingerprint reach ``min_count``,
   the answer is a bit at the place it was sent from: (pack, place) is its occurrence pointer.
3. Packs read the bits and spell out only those n-grams, counted by their word numbers and
   so by their text; counts are added by phrase.  Two phrases with one fingerprint thus come
   apart here: a collision costs work and changes no result.
4. Scores, cuts, containment and rank are DataFrame functions over the frequent phrases.

Nothing grows in one place: a word however common is one number per pack, a segment of
fingerprints holds about ``SEGMENT_BYTES`` of text's worth, and a language however large is
many packs.

Defined results: a null text is empty; a null language is ``und``; repeated rows count again
and a null id matters not; a language without candidates has no rows; an empty table has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import only
from starmart.session import stage

PACK_BYTES = 8 << 20
SEGMENT_BYTES = 16 << 20
FINGERPRINT_BITS = 64
FIRST_ROUND = 64
SENT_BYTES = 6  # of a fingerprint, beside its segment
MIN_COUNT, MAX_WORDS, TOP, CONTAINED_PERCENT = 10, 3, 2000, 50

# --- fingerprints ------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_WINDOW = 1 << 20


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; for windows of one size, so made once in a worker."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(size + 1, base, np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tables[0], tables[1]


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(32)
    return x >> np.uint64(64 - FINGERPRINT_BITS)


def fingerprints(letters: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each ``letters[begin:end]`` (begins and ends ascend) from differences of prefix polynomials."""
    out = np.empty(len(begins), np.uint64)
    k = 0
    while k < len(begins):
        low = begins[k]
        stop = max(k + 1, int(np.searchsorted(ends, low + _WINDOW, "right")))
        size = int(ends[stop - 1] - low)
        power, inverse = _powers(max(size, _WINDOW))
        prefix = np.zeros(size + 1, np.uint64)
        np.cumsum((letters[low : low + size].astype(np.uint64) + np.uint64(1)) * power[:size], out=prefix[1:])
        b, e = begins[k:stop] - low, ends[k:stop] - low
        out[k:stop] = (prefix[e] - prefix[b]) * inverse[b] + (e - b).astype(np.uint64)
        k = stop
    return _mix(out)


# --- packs -------------------------------------------------------------------------------

# What parts words, and what parts pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _same_bytes(text: np.ndarray, begins: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> bool:
    """Whether text[begin:begin+size] equals text[other:other+size] for every row."""
    step = 1 << 17
    for k in range(0, len(begins), step):
        size = sizes[k : k + step]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        own = text[np.repeat(begins[k : k + step], size) + inside]
        if not np.array_equal(own, text[np.repeat(others[k : k + step], size) + inside]):
            return False
    return True


def intern(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(numbers, words): the text as word numbers from 1, most frequent first, and 0 where a piece ends."""
    text = np.frombuffer(blob.translate(_LOWER), np.uint8)
    kind = _KIND[text]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], kind == 0, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return np.zeros(0, np.uint32), []
    keys = fingerprints(text, begins, ends)
    _, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    sizes = ends - begins
    others = first[which]
    if not (np.array_equal(sizes, sizes[others]) and _same_bytes(text, begins, sizes, begins[others])):
        raw = text.tobytes()  # two words with one fingerprint: number this pack's words by their bytes
        numbered: dict[bytes, int] = {}
        which = np.array([numbered.setdefault(raw[b:e], len(numbered)) for b, e in zip(begins.tolist(), ends.tolist())])
        _, first, counts = np.unique(which, return_index=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(1, len(order) + 1)
    piece = np.cumsum(kind == 2)[begins]
    new = np.flatnonzero(np.diff(piece)) + 1
    numbers = np.insert(rank[which], new, 0)
    raw = text.tobytes()
    return numbers, [raw[begins[k] : ends[k]] for k in first[order].tolist()]


def _dump(numbers: np.ndarray, words: list[bytes]) -> tuple[bytes, bytes]:
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return tuple(
        len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) for raw in (planes, b" ".join(words))
    )


def _load(body: bytes) -> bytes:
    return pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)


class Pack:
    """Word numbers of a pack, and which n-grams the answers so far have found frequent."""

    def __init__(self, lang: str, numbers: np.ndarray, words: list[bytes]):
        self.numbers, self.words = numbers, words
        salt = np.frombuffer(lang.encode(), np.uint8)
        spelt = np.frombuffer(b"".join(words), np.uint8)
        stops = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
        letters = fingerprints(spelt, np.concatenate([[0], stops[:-1]]) if words else stops, stops)
        of_lang = fingerprints(salt, np.array([0]), np.array([len(salt)]))
        self.letters = np.concatenate([np.zeros(1, np.uint64), letters ^ of_lang])[numbers]
        self.places: list[np.ndarray] = []  # where a frequent n-gram begins, for n = 1, 2 ..

    def candidates(self) -> np.ndarray:
        """Where the next longer n-grams begin that may be frequent."""
        if not self.places:
            return np.flatnonzero(self.numbers)
        last = self.places[-1]
        return last[:-1][np.diff(last) == 1]

    def grams(self, segments: int):
        """(candidate places, index of each one's fingerprint, segment and key of the fingerprints in sent order, counts)."""
        at = self.candidates()
        n = len(self.places) + 1
        keys, which, counts = np.unique(fingerprints(self.letters, at, at + n), return_inverse=True, return_counts=True)
        segment = (keys % np.uint64(segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return at, place[which], segment[order], keys[order], counts[order]

    def hear(self, answers: dict[int, bytes], segments: int) -> None:
        """Take the bits of one round: segment -> one bit for each fingerprint that was sent there."""
        at, which, segment, _, _ = self.grams(segments)
        cuts = np.flatnonzero(np.diff(segment, prepend=-1, append=-1))
        frequent = [
            np.unpackbits(np.frombuffer(answers[int(segment[b])], np.uint8), count=e - b) for b, e in zip(cuts, cuts[1:])
        ]
        self.places.append(at[np.concatenate(frequent).astype(bool)[which]] if frequent else at)

    def spelt(self) -> Iterator[tuple[str, int]]:
        """The n-grams of all rounds with their counts, told apart by their words."""
        base = np.uint64(len(self.words) + 1)
        text = [w.decode() for w in self.words]
        for n, at in enumerate(self.places, 1):
            code = self.numbers[at].astype(np.uint64)
            for k in range(1, n):  # number the n-grams so far, then add a word: never beyond 64 bits
                _, code = np.unique(code, return_inverse=True)
                code = code.astype(np.uint64) * base + self.numbers[at + k]
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            rows = np.stack([self.numbers[at[first] + k] for k in range(n)], axis=1) - 1 if len(first) else []
            for numbers, count in zip(np.asarray(rows).tolist(), counts.tolist()):
                yield " ".join(map(text.__getitem__, numbers)), count


PACK_SCHEMA = "pack long, lang string, n_bytes long, n_words long, numbers binary, words binary"


def write_packs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Packs of word numbers, written once to the shared folder."""
    source = only(docs, lang=lang_col, text=text_col).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )

    def row(number: int, lang: str, texts: list[str]) -> pa.RecordBatch:
        blob = "\n".join(texts).encode()
        numbers, words = intern(blob)
        body, spelt = _dump(numbers, words)
        values = [number, lang, len(blob), int(np.count_nonzero(numbers)), body, spelt]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in PACK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, total = TaskContext.get().partitionId() << 32, {}, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                total += len(text)
                # A full pack goes; of very many languages all go once they hold a few packs together.
                for full in [lang] if size[lang] >= pack_bytes else list(held) if total >= 4 * pack_bytes else ():
                    total -= size.pop(full)
                    yield row(number, full, held.pop(full))
                    number += 1
        for lang, texts in held.items():
            yield row(number, lang, texts)
            number += 1

    return stage(source.mapInArrow(run, PACK_SCHEMA), "packs")


# --- rounds ------------------------------------------------------------------------------


def _with_answers(packs: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Each pack with its answers, as (round, segment, bits); at most a bit for an n-gram of the pack."""
    if not answers:
        return packs.withColumn("answers", F.lit(None).cast("array<struct<round: int, segment: int, bits: binary>>"))
    told = answers[0]
    for more in answers[1:]:
        told = told.union(more)
    by_pack = told.groupBy("pack").agg(F.collect_list(F.struct("round", "segment", "bits")).alias("answers"))
    return packs.join(by_pack, "pack", "left")


def _packs(batches: Iterable[pa.RecordBatch], segments: int) -> Iterator[tuple[int, str, Pack]]:
    for batch in batches:
        for k in range(batch.num_rows):  # one pack at a time
            row = batch.slice(k, 1).to_pylist()[0]
            planes = np.frombuffer(_load(row["numbers"]), np.uint8)
            numbers = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
            spelt = _load(row["words"])
            pack = Pack(row["lang"], numbers, spelt.split(b" ") if spelt else [])
            rounds: dict[int, dict[int, bytes]] = {}
            for a in row["answers"] or ():
                rounds.setdefault(a["round"], {})[a["segment"]] = a["bits"]
            for n in sorted(rounds):
                pack.hear(rounds[n], segments)
            yield row["pack"], row["lang"], pack


def _frequent(packs: DataFrame, answers: list[DataFrame], segments: int, min_count: int, sent_bytes: int) -> DataFrame:
    """One round: packs send fingerprints, segments answer with bits."""
    number = len(answers) + 1
    narrow = np.uint16 if min_count < 1 << 16 else np.uint64

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, pack in _packs(batches, segments):
            if len(pack.places) < number - 1:  # nothing was sent in the round before
                continue
            _, _, segment, keys, counts = pack.grams(segments)
            low = np.ascontiguousarray(keys >> np.uint64(8 * (8 - sent_bytes))).view(np.uint8).reshape(-1, 8)[:, :sent_bytes]
            few = np.minimum(counts, min_count).astype(narrow)
            cuts = np.flatnonzero(np.diff(segment, prepend=-1, append=-1)).tolist() if len(segment) else [0]
            spans = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(segment[b]) for b, _ in spans], pa.int32()), pa.array([name] * len(spans), pa.int64()),
                pa.array([low[b:e].tobytes() for b, e in spans], pa.binary()),
                pa.array([few[b:e].tobytes() for b, e in spans], pa.binary()),
            ], names=["segment", "pack", "sent", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        sent = group.column("sent").to_pylist()
        sizes = [len(s) // sent_bytes for s in sent]
        keys = np.zeros((sum(sizes), 8), np.uint8)
        keys[:, :sent_bytes] = np.frombuffer(b"".join(sent), np.uint8).reshape(-1, sent_bytes)
        counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), narrow)
        _, which = np.unique(keys.view("<u8").ravel(), return_inverse=True)
        often = (np.bincount(which, counts) >= min_count)[which]
        stops = np.cumsum(sizes).tolist()
        return pa.table({
            "pack": group.column("pack"), "round": pa.array([number] * len(sizes), pa.int32()), "segment": group.column("segment"),
            "bits": pa.array([np.packbits(often[e - s : e]).tobytes() for s, e in zip(sizes, stops)], pa.binary()),
        })

    messages = _with_answers(packs.select("pack", "lang", "numbers", "words"), answers).mapInArrow(
        send, "segment int, pack long, sent binary, counts binary"
    )
    told = messages.groupBy("segment").applyInArrow(answer, "pack long, round int, segment int, bits binary")
    return stage(told, "phrase-bits")


def phrase_counts(
    packs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, sent_bytes: int = SENT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """(lang, phrase, f) of all phrases of up to ``max_words`` words with f >= ``min_count``."""
    segments = 1 + (packs.agg(F.sum("n_bytes")).first()[0] or 0) // segment_bytes
    answers: list[DataFrame] = []
    for _ in range(max_words):
        answers.append(_frequent(packs, answers, segments, min_count, sent_bytes))

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lang, pack in _packs(batches, segments):
            found = list(pack.spelt())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(found), pa.string()), pa.array([p for p, _ in found], pa.string()),
                pa.array([c for _, c in found], pa.int64()),
            ], names=["lang", "phrase", "f"])

    heard = _with_answers(packs.select("pack", "lang", "numbers", "words"), answers)
    spelt = heard.mapInArrow(spell, "lang string, phrase string, f long")
    return spelt.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


# --- scores ------------------------------------------------------------------------------


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    top: int = TOP, contained_percent: int = CONTAINED_PERCENT, pack_bytes: int = PACK_BYTES, sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Products are decimals of 38 digits, so they are exact up to counts of 10^16.
    """
    packs = write_packs(docs, text_col, lang_col, pack_bytes)
    totals = packs.groupBy("lang").agg(F.sum("n_words").alias("n"))
    phrases = stage(phrase_counts(packs, min_count, max_words, sent_bytes), "phrases")
    several = phrases.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words")).where("size > 1")
    cuts = several.select(
        "lang", "phrase", F.col("f").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(words, k + 1, size)"), " ").alias("tail"),
    )
    left = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = {c: f"cast({c} as decimal(19,0))" for c in "alr"}
    score = F.expr("(1000000BD * {a} * {a}) div ({l} * {r})".format(**exact))
    lowest = (
        cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    inner = several.where("size > 2").select(
        "lang", "f", F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), b -> slice(words, b, s))))"
        )).alias("part")
    ).groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("f").alias("longest"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = lowest.join(inner, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longest") < contained_percent * F.col("a"), F.lit(True))
    )
    scored = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The best of each of ``FIRST_ROUND`` parts of a language first: the last round is small however large the language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(FIRST_ROUND))
    heats = Window.partitionBy("lang", part).orderBy(*order)
    scored = scored.withColumn("rank", F.row_number().over(heats)).where(F.col("rank") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
