"""Exact, near, byte and span dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import exact_dedup, fragments, simhash_dedup, substring_dedup, suffix_array_dedup
from starmart.llm.common import connected_components
from tests.llm.conftest import AWKWARD, CLASHES

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def small_texts(small):
    return [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]


# --- exact -------------------------------------------------------------------------------


def exact_brute(pairs):
    keyed = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in pairs]
    groups = defaultdict(list)
    for i, t in keyed:
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    out, seen = [], set()
    for i, t in keyed:
        kept = i == least[t] and t not in seen
        if kept:
            seen.add(t)
        out.append((i, least[t], len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("bits", [exact_dedup.MAX_FILTER_BITS, 128])
def test_exact_marks(docs_of, small, small_texts, bits):
    for df, pairs in ((docs_of(AWKWARD, CLASHES), AWKWARD), (small, small_texts)):
        got = exact_dedup.mark_duplicates(df.limit(10**9), max_filter_bits=bits if len(pairs) < 50 else exact_dedup.MAX_FILTER_BITS)
        assert Counter(rows(got)) == exact_brute(pairs)


def test_exact_keeps_one_row_with_all_columns(docs_of):
    df = docs_of(AWKWARD, CLASHES)
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 7, 8, 9]
    assert exact_dedup.keep_first(df.where("false")).count() == 0
    assert rows(exact_dedup.mark_duplicates(df.where("false"))) == []


def test_unique_rows_are_not_shuffled_as_rows(small):
    plan = exact_dedup.keep_first(small)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "Python" not in plan


# --- near --------------------------------------------------------------------------------


def fingerprint_brute(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(fps):
    own = list(range(len(fps)))

    def root(k):
        while own[k] != k:
            k = own[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                own[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(fps))]


def test_near_components(docs_of, small, small_texts):
    for df, pairs in ((docs_of(AWKWARD, CLASHES), AWKWARD), (small, small_texts)):
        fps = [fingerprint_brute(t) for _, t in pairs]
        group = components_brute(fps)
        least = {g: min((i for (i, _), h in zip(pairs, group) if h == g and i is not None), default=None) for g in group}
        want = Counter((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(pairs, fps, group))
        assert Counter(rows(simhash_dedup.cluster(df))) == want
    assert rows(simhash_dedup.cluster(small.where("false"))) == []


@pytest.mark.parametrize("crowded", [1, 256])
def test_links_connect_what_the_radius_connects(spark, crowded):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 6)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(40):
            flipped = int(s)
            for bit in rng.choice(63, rng.integers(1, 5), replace=False):
                flipped ^= 1 << int(bit)
            fps.add(flipped)
    fps = sorted(fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash_dedup.links(frame, max_bucket=crowded)
    assert all(bin(a ^ b).count("1") <= 2 for a, b in rows(edges))
    got = dict(rows(connected_components(edges)))
    group = components_brute(fps)
    assert [got.get(f, f) for f in fps] == [fps[g] for g in group]


def test_near_copies_stage(docs_of):
    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in range(3000)]
    base = [list(rng.choice(words, 200)) for _ in range(30)]
    pairs, drop = [], set()
    for n, ws in enumerate(base):
        pairs.append((10 * n, " ".join(ws)))
        if n % 2:
            changed = list(ws)
            changed[50], changed[150] = "other", "thing"  # ten of 196 shingles: 0.9 similar
            pairs.append((10 * n + 1, " ".join(changed).upper()))
            drop.add(10 * n + 1)
        else:
            pairs.append((10 * n + 2, " ".join(ws[:100] + list(rng.choice(words, 100)))))  # a third similar
    pairs += [(1000, None), (1001, "..."), (None, "a b c")]
    df = docs_of(pairs, CLASHES)
    kept = simhash_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in pairs} - drop


def copies_brute(pairs):
    """Ids that stay: the smallest of each component of texts whose five-word shingles are 0.8 similar."""
    sets = []
    for _, t in pairs:
        ws = t.lower().split()
        sets.append({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))})
    own = list(range(len(pairs)))

    def root(k):
        while own[k] != k:
            k = own[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                own[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        least[root(k)] = min(least.get(root(k), i), i)
    return set(least.values())


def test_star_of_near_copies(docs_of):
    rng = np.random.default_rng(8)
    words = [f"w{n}" for n in range(5000)]
    base = list(rng.choice(words, 200))
    pairs = [(50, " ".join(base))]
    for n in range(100):  # each near to the base, few near to one another
        ws = list(base)
        for at in rng.choice(np.arange(5, 195, 6), 3, replace=False):
            ws[at] = f"c{n}-{at}"
        pairs.append((n if n < 50 else n + 1, " ".join(ws)))
    passage = list(rng.choice(words, 150))
    pairs += [(1000 + n, " ".join(passage + list(rng.choice(words, 50)))) for n in range(60)]  # two thirds similar
    want = copies_brute(pairs)
    assert len(want) == 61
    assert {r["doc_id"] for r in simhash_dedup.keep_one(docs_of(pairs, CLASHES)).collect()} == want


def test_a_crowd_of_texts_not_similar_enough_makes_few_pairs(docs_of):
    rng = np.random.default_rng(21)
    base, pairs = [f"w{n}" for n in rng.permutation(5000)[:150]], []
    for n in range(120):  # three to six words of the base changed: most pairs are just not 0.8 similar
        ws = list(base)
        for at in rng.choice(150, 3 + n % 4, replace=False):
            ws[at] = f"c{n}-{at}"
        pairs.append((n, " ".join(ws)))
    docs = docs_of(pairs)
    sketches = simhash_dedup._sketches(docs.select(F.xxhash64("doc_id", "text").alias("node"), "doc_id", "text"), 5, 0.8)
    odd = [F.col("parity")[k].alias(f"odd{k}") for k in range(simhash_dedup.PARITY_LONGS)]
    rows = sketches.select(F.col("node").alias("component"), "node", "size", *odd, F.posexplode("keys").alias("at", "key"))
    found = simhash_dedup._meeting(rows, 0.8)[0].select("node_a", "node_b").collect()
    names = {r.node: r.doc_id for r in sketches.select("node", "doc_id").collect()}
    grams = {i: {tuple(t.split()[k : k + 5]) for k in range(146)} for i, t in pairs}
    alike = {(a, b) for a in grams for b in range(a) if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])}
    met = {(max(names[r.node_a], names[r.node_b]), min(names[r.node_a], names[r.node_b])) for r in found}
    assert alike <= met and len(met) < 3570  # of 7140
    assert {r["doc_id"] for r in simhash_dedup.keep_one(docs).collect()} == copies_brute(pairs)


def test_near_copies_with_repeated_lines_and_at_the_border(docs_of):
    rng = np.random.default_rng(11)
    words = [f"w{n}" for n in range(20000)]
    pairs = []
    for n in range(60):  # the same set of shingles but for a line said 30 times more
        ws = list(rng.choice(words, 200))
        pairs += [(10 * n, " ".join(ws)), (10 * n + 1, " ".join(ws[:100] + ws[86:100] * 30 + ws[100:]))]
    for n in range(60, 260):  # 175 of 217 shingles in common: 0.806 similar; then 174 of 218: 0.798
        ws = list(rng.choice(words, 200))
        for k, last in ((1, [0]), (2, [1])):
            other = list(ws)
            for at in (20, 60, 100, 140, *last):
                other[at] = f"{k}-{n}-{at}"
            pairs.append((10 * n + k, " ".join(other)))
        pairs.append((10 * n, " ".join(ws)))
    want = copies_brute(pairs)
    assert {r["doc_id"] for r in simhash_dedup.keep_one(docs_of(pairs)).collect()} == want
    assert len(want) == 60 + 400


def test_the_stage_links_what_the_operator_links(spark, docs_of):
    rng = np.random.default_rng(4)
    words, pairs = [f"w{n}" for n in range(3000)], []
    for n in range(12):
        # One tail apart in a text of few shingles, but one line said over and over: 0.5 similar, equal fingerprints.
        line = " ".join(rng.choice(words, 12))
        pairs += [(10 * n + k, f"{line} " * 80 + f"{n}-{k} and so on") for k in range(2)]
    pairs += [(1000 + n, " ".join(rng.choice(words, 50))) for n in range(20)]
    pairs += [(2000, None), (2001, ""), (None, " \n"), (3000, "said twice by one id"), (3000, "said twice by one id"), (3000, "something else of it")]
    docs = docs_of(pairs, CLASHES)
    apart = {(r.fingerprint, r.component_id) for r in simhash_dedup.cluster(docs.where("doc_id < 120")).collect()}
    want = Counter([*{c for _, c in apart}, *range(1000, 1020), 2000, 3000, 3000])
    assert 12 <= len({c for _, c in apart}) < 24
    kept = corpus_pipeline.near(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == want
    alone = simhash_dedup.keep_one(docs).collect()
    assert Counter(r["doc_id"] for r in alone) == Counter([i for i, _ in pairs if i != 3000] + [3000, 3000])


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(edges).collect()} == {0}


# --- bytes and spans -----------------------------------------------------------------------


def bytes_brute(pairs):
    first = {}
    for i, t in pairs:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p : p + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in pairs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def spans_brute(pairs):
    seen, out = {}, []
    for i, t in sorted(pairs, key=lambda x: x[0]):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            w = tuple(words[p : p + 20])
            if w in seen:
                gone[p : p + 20] = [True] * 20
            else:
                seen[w] = i
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


def overlapping(seed, letters):
    """Texts that share passages at all offsets, with runs of one word or letter and whole copies."""
    rng = np.random.default_rng(seed)
    passages = [" ".join(rng.choice(letters, 60)) for _ in range(6)] + ["a" * 130, "b " * 70]
    out = []
    for i in range(60):
        parts = []
        for _ in range(rng.integers(0, 4)):
            own = passages[rng.integers(len(passages))]
            lo = rng.integers(0, len(own) // 2)
            parts += [own[lo : lo + rng.integers(20, 200)], " ".join(rng.choice(letters, rng.integers(1, 30)))]
        out.append((i, " ".join(parts)))
    return out + [(100, out[3][1]), (101, out[3][1]), (102, None), (103, ""), (104, "é" * 60), (105, "x" + "é" * 60)]


@pytest.mark.parametrize("hot", [0, 64])
def test_bytes_and_spans(docs_of, monkeypatch, hot):
    monkeypatch.setattr(fragments, "HOT_PACKS", hot)
    monkeypatch.setattr(fragments, "PACK_BYTES", 2000)
    pairs = overlapping(hot, ["ab", "c", "de", "a", "b"])
    df = docs_of(pairs, CLASHES).repartition(3)
    assert Counter(rows(suffix_array_dedup.remove_repeats(df))) == bytes_brute(pairs)
    assert Counter(rows(substring_dedup.remove_spans(df))) == spans_brute(pairs)


def test_bytes_and_spans_of_the_table(small, small_texts):
    assert Counter(rows(suffix_array_dedup.remove_repeats(small))) == bytes_brute(small_texts)
    assert Counter(rows(substring_dedup.remove_spans(small))) == spans_brute(small_texts)


def test_bytes_and_spans_of_awkward_rows(docs_of):
    df = docs_of(AWKWARD, CLASHES)
    assert suffix_array_dedup.remove_repeats(df).count() == len(AWKWARD)
    spans = {r.doc_id: r.n_removed for r in substring_dedup.remove_spans(df).where("n_words > 20").collect()}
    assert spans == {7: 4999}
    for run in (suffix_array_dedup.remove_repeats, substring_dedup.remove_spans):
        assert rows(run(df.where("false"))) == []


def test_anchors_are_dealt_evenly():
    body = np.random.default_rng(2).integers(97, 123, 1 << 18, dtype=np.uint8)
    values = np.unique(fragments.cut(body, np.array([len(body)]), 50, 24).value)
    dealt = np.diff(fragments._shard_bounds(values, 64))
    assert dealt.sum() == len(values) and dealt.max() < 2 * dealt.mean()


def test_a_pack_sends_a_row_to_a_shard_and_its_texts_do_not_move(spark, docs_of, monkeypatch):
    monkeypatch.setattr(fragments, "PACK_BYTES", 500)
    texts = docs_of(overlapping(5, ["ab", "c", "de"])).coalesce(1).selectExpr("doc_id", "text AS digest", "text")
    packs = fragments.write_packs(texts)
    assert fragments.PACK_PARTS in {len(r.members) for r in packs.collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reading = suffix_array_dedup.READING
        dealt = fragments.deal_fragments(packs, fragments.repeated_anchors(packs, reading, 3), reading, 3)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        rows = dealt.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < len(rows) <= 3 * packs.count() and len({(r.shard, r.pack) for r in rows}) == len(rows)
    # What is told of anchors goes to the shards and back to the packs; these stay where they were written.
    assert plan.count("Exchange hashpartitioning(shard") == plan.count("Exchange hashpartitioning(pack") == plan.count("Exchange ") - 1 == 1


def test_sorted_suffixes_and_disk_queues(monkeypatch):
    monkeypatch.setattr(suffix_array_dedup, "QUEUE_BYTES", 64)
    rng = np.random.default_rng(1)
    for _ in range(40):
        parts = [np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 40)), 0) for _ in range(rng.integers(1, 6))]
        letters = np.concatenate(parts).astype(np.uint16)
        own = letters.tolist()
        order = [i for i in suffix_array_dedup.sorted_suffixes(letters, 50).tolist() if own[i]]
        assert sorted(order) == [i for i, x in enumerate(own) if x]
        suffixes = [own[i : own.index(0, i)] for i in order]
        assert suffixes == sorted(suffixes)


def test_automaton():
    automaton = substring_dedup.SuffixAutomaton()
    for part in ("abcab", "bcabd"):
        automaton.add([ord(c) for c in part])
    assert automaton.matching([ord(c) for c in "xabcabd"]) == [0, 1, 2, 3, 4, 5, 5]


def test_maps_of_two_sizes_fold_to_one(spark):
    """A map folded to a power of two below equals the map made so; longer sets have longer maps."""
    rng = np.random.default_rng(3)
    assert [simhash_dedup._map_bits(n) for n in (1, 256, 257, 5000)] == [1024, 1024, 2048, 32768]
    hashes = rng.integers(0, 1 << 63, 700, dtype=np.uint64)

    def bits(size):
        own = np.zeros(size, np.uint8)
        own[(hashes % np.uint64(size)).astype(np.int64)] = 1
        return np.packbits(own).view(np.int64).tolist()

    df = spark.createDataFrame([(bits(8192), n // 64, bits(n)) for n in (1024, 2048, 8192)], "m array<long>, longs int, want array<long>")
    for row in df.withColumn("got", simhash_dedup._folded(F.col("m"), F.col("longs"))).collect():
        assert row.got == row.want


def test_near_copies_of_long_texts_of_unlike_sizes(docs_of):
    """Texts whose maps have different sizes: 0.85 similar ones are linked, texts that share half are not."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(1000)]
    longer = base + [f"x{k}" for k in range(160)]
    half = base[:500] + [f"y{k}" for k in range(560)]
    docs = docs_of([(1, " ".join(base)), (2, " ".join(longer)), (3, " ".join(half)), (4, "some thing else")])
    assert sorted(r.doc_id for r in simhash_dedup.keep_one(docs).collect()) == [1, 3, 4]
