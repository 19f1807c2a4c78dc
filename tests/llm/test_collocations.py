"""Phrase mining against a brute-force version, with and without collisions of fingerprints."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import collocations as mining
from tests.llm.conftest import AWKWARD, CLASHES

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(rows, min_count=10, max_words=3, top=2000, percent=50):
    """Rows are (text, lang)."""
    out, counts, totals = [], defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, max_words + 1):
                for k in range(len(words) - n + 1):
                    counts[lang][tuple(words[k : k + n])] += 1
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    inside[p[k : k + size]] = max(inside[p[k : k + size]], a)
        ranked = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def made_up(seed, count):
    rng = random.Random(seed)
    words = ["a", "B", "ab", "b a", "aB\tc", "é", "日本", "　x", "x\x0by", "The", "the", "!", "a.b", "x  y"]
    return [
        (k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, "", "und"]))
        for k in range(count)
    ]


@pytest.mark.parametrize("bits, sent", [(64, 6), (64, 1), (7, 6)])
def test_equals_brute_force(docs_of, monkeypatch, bits, sent):
    rows = made_up(bits + sent, 120) + [(r[0], r[1]) for r in AWKWARD] * 4
    whole = mining.collocations(docs_of(rows, CLASHES + ";1 AS phrase;2 AS f;'x' AS pack").repartition(5), pack_bytes=700)
    assert rows_of(whole) == brute_force([(r[1], r[2] if len(r) > 2 else None) for r in rows])
    # Collisions: the packs' code runs here, with fingerprints of a few bits.
    monkeypatch.setattr(mining, "FINGERPRINT_BITS", bits)
    text = " ".join(r[1] for r in rows if r[1])
    numbers, words = mining.intern(text.encode())
    spelt = [words[k - 1].decode() if k else None for k in numbers.tolist()]
    assert len(set(words)) == len(words)
    want = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER))]
    assert [w for w in spelt if w is not None] == [w for p in want for w in p]
    pieces = "\n".join(" ".join(p) for p in want if p)
    assert " ".join("\n" if w is None else w for w in spelt).replace(" \n ", "\n") == pieces


def test_collisions_change_no_result(docs_of):
    """Keys of one byte in a single segment: nearly all n-grams meet others."""
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(60)), "en") for k in range(150)]
    got = mining.collocations(docs_of(rows).repartition(4), pack_bytes=1500, sent_bytes=1)
    assert rows_of(got) == brute_force([r[1:] for r in rows]) != []


def test_longer_phrases_and_one_hot_passage(docs_of):
    rows = [(k, "once upon a time there was a hot line. once upon a time", "en") for k in range(400)] + made_up(3, 30)
    got = mining.collocations(docs_of(rows).repartition(6), min_count=4, max_words=5, top=7, pack_bytes=900)
    assert rows_of(got) == brute_force([(r[1], r[2]) for r in rows], 4, 5, 7)


def test_empty_and_blank(docs_of):
    assert mining.collocations(docs_of([(1, "a b")]).where("false")).collect() == []
    assert mining.collocations(docs_of([(1, None), (2, ""), (3, " .,\n")])).collect() == []


def test_exact_beyond_64_bits(spark):
    """Score of counts whose products need 100 bits."""
    df = spark.sql("SELECT 3000000000000001L AS a, 7000000000000003L AS l, 9000000000000011L AS r")
    got = df.selectExpr("(1000000BD * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").first()[0]
    assert got == 1_000_000 * 3000000000000001**2 // (7000000000000003 * 9000000000000011)


def test_fingerprints_over_windows(monkeypatch):
    letters = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    begins = np.arange(0, 4900, 7)
    ends = begins + 5
    whole = mining.fingerprints(letters, begins, ends)
    monkeypatch.setattr(mining, "_WINDOW", 64)
    assert np.array_equal(whole, mining.fingerprints(letters, begins, ends))
    same = np.concatenate([letters[7:12], letters[:100]])
    assert mining.fingerprints(same, np.array([0]), np.array([5]))[0] == whole[1]
