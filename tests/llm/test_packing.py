"""Best-fit packing: rules of the bins, pieces against the library, sequences without gaps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmart.llm import best_fit_packing as packing
from starmart.llm.library_ids import WordIds, splits_at_spaces
from tests.llm.conftest import AWKWARD, CLASHES

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SF_DIR = "/root/testdata/sf0.001"


def plain_best_fit(lengths, capacity, open_bins):
    """Bins as a list, searched through for each item."""
    bins, live, places = [], [], []
    for n in lengths:
        fits = [b for b in live if capacity - bins[b] >= n]
        if fits:
            best = max(bins[b] for b in fits)
            b = [b for b in fits if bins[b] == best][-1]
            live.remove(b)
        else:
            b = len(bins)
            bins.append(0)
        places.append((b, bins[b]))
        bins[b] += n
        if bins[b] < capacity:
            if len(live) == open_bins:
                fullest = max(bins[x] for x in live)
                live.remove([x for x in live if bins[x] == fullest][-1])
            live.append(b)
    return places, {b: bins[b] for b in live}


@pytest.mark.parametrize("open_bins", [1, 3, 1000])
def test_bins_equal_a_plain_search(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.choice([1, 2, 30, 31, 60, 99, 100, rng.randint(1, 100)]) for _ in range(3000)]
    packer = packing.BestFit(100, open_bins)
    got = [packer.put(n) for n in lengths]
    want, left = plain_best_fit(lengths, 100, open_bins)
    # Which of several equally full bins is taken is free; fills must agree item by item.
    assert [p for _, p in got] == [p for _, p in want]
    assert sorted(packer.still_open().values()) == sorted(left.values())
    assert packer.count <= open_bins


def test_pieces_of_a_document():
    assert list(packing.cut(1, 10)) == [(0, 1)]
    assert list(packing.cut(20, 10)) == [(0, 10), (10, 10)]
    assert list(packing.cut(23, 10)) == [(0, 3), (3, 10), (13, 10)]


def check(rows, docs, capacity, end=2):
    library = Tokenizer.from_file(BYTES)
    want = defaultdict(list)
    for doc, text in docs:
        want[doc].append(library.encode(text or "", add_special_tokens=False).ids + [end])
    pieces = []
    for doc, texts in want.items():
        for ids in texts:
            for k, (start, length) in enumerate(packing.cut(len(ids), capacity)):
                raw = np.array(ids[start : start + length], "<u4").tobytes()
                pieces.append((doc, k, start, length, zlib.crc32(raw)))
    assert sorted(map(str, pieces)) == sorted(str(tuple(r)[:5]) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return len(sequences), sum(p[3] for p in pieces)


def test_awkward_rows(docs_of, spark):
    rows = packing.pack(docs_of(AWKWARD, CLASHES).repartition(3), BYTES).collect()
    check(rows, AWKWARD, 1024)
    assert packing.pack(docs_of(AWKWARD).where("false"), BYTES).collect() == []


def test_table_is_packed_tightly_from_many_tasks(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    for open_bins, loss in ((2, 1.1), (256, 1.06)):
        rows = packing.pack(table.repartition(20), BYTES, open_bins=open_bins).collect()
        made, ids = check(rows, docs, 1024)
        assert made <= loss * ids / 1024 + 1


def test_ids_by_word_equal_the_library():
    own, library = WordIds(BYTES), Tokenizer.from_file(BYTES)
    rng = random.Random(4)
    texts = ["", " ", "a  b\n c", " x\n y <|endoftext|> z.", "a 　b c", "x\x1c y", "don't 's  it's!?", "日本, é; ß: ½. ...", "<|endoftext|>."]
    texts += ["".join(rng.choice("aeinst hTHé12!'.,\n 日") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    for part in (pa.array(texts), pa.array(texts).slice(3, 700)):
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(part)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in part.to_pylist()]


def test_memory_of_words_is_bounded(monkeypatch):
    from starmart.llm import library_ids

    monkeypatch.setattr(library_ids, "REMEMBERED_BYTES", 40_000)
    monkeypatch.setattr(library_ids, "BLOCK_BYTES", 2_000)
    own, library = WordIds(BYTES), Tokenizer.from_file(BYTES)
    texts = [" ".join(f"w{(k * j) % 977}x" for j in range(60)) for k in range(300)]
    got = own.encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 230 * (len(own.words) + len(own.older)) < 3 * 40_000


def test_other_settings_get_whole_texts():
    assert not splits_at_spaces({"normalizer": {"type": "NFC"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}})
    own, library = WordIds(WORDS), Tokenizer.from_file(WORDS)
    assert not own.by_word
    assert np.frombuffer(own.encode(pa.array(["Two  words"]))[0], "<u4").tolist() == library.encode("Two  words", add_special_tokens=False).ids
