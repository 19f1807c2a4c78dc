"""Token files, byte-pair encoding and counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from starmart.llm import bpe_prefix, repair_ids, viterbi_counts
from tests.llm.conftest import AWKWARD, CLASHES

WORDS, BYTES, MODEL = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
SF_DIR = "/root/testdata/sf0.001"


def noise(seed, letters, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def table_texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_prefix_encoding_equals_the_library():
    own, library = bpe_prefix.PrefixEncoder(BYTES), Tokenizer.from_file(BYTES)
    odd = ["aaaaaaaaaaaaaaaa aaaa", "x<|endoftext|>y<|endoftext|>", "\x1c\x1d a\x85b\xa0c ½²", " \n \t a   b", "日本 🙂🙂"]
    for text in odd + noise(1, "aeinst hTHé12!'\n", 1500):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_encode_decode_rows(docs_of, spark, table_texts):
    library = Tokenizer.from_file(BYTES)
    for df, pairs in ((docs_of(AWKWARD, CLASHES), AWKWARD), (spark.read.parquet(f"{SF_DIR}/documents.parquet"), table_texts)):
        want = []
        for i, t in pairs:
            ids = library.encode(t or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((i, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]))
        got = [tuple(r) for r in bpe_prefix.encode_decode(df, BYTES).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_prefix.encode_decode(df.where("false"), BYTES).count() == 0


def test_no_encoder_is_left_where_stages_share_the_worker(docs_of, monkeypatch):
    docs = docs_of(AWKWARD)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda frame, run, schema: run)
    monkeypatch.setattr(bpe_prefix, "FEW_REMEMBERED", 20)
    rows = [(n, t) for n, t in enumerate(noise(4, "ab c", 300))]
    batch = pa.RecordBatch.from_pylist([{"doc_id": n, "text": t} for n, t in rows])
    most = []
    forget = bpe_prefix.PrefixEncoder.forget
    monkeypatch.setattr(bpe_prefix.PrefixEncoder, "forget", lambda enc, *a: (forget(enc, *a), most.append(len(enc.known)))[0])
    out = pa.Table.from_batches(bpe_prefix.encode_decode(docs, BYTES, ids=True, remember=False)(iter([batch]))).to_pylist()
    library = Tokenizer.from_file(str(BYTES))
    assert [r["ids"] for r in out] == [library.encode(t, add_special_tokens=False).ids for _, t in rows]
    assert max(most) <= 20 and bpe_prefix.encoder.cache_info().currsize == 0


def test_pieces_equal_the_library():
    own, library = repair_ids.PieceEncoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ["x<|endoftext|> y", "a\x1cb", "ΣΑΣ İ", "²x½"] + noise(3, "aeS'tdsÉßªº 12!'_\n\xa0\x85\x1c<|ΣéİT-", 1500)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_grammar_round_trip_and_ranges():
    rng = np.random.default_rng(2)
    motif = rng.integers(2, 50, 40)
    ids = np.concatenate([np.concatenate([motif, rng.integers(2, 50, 5), [1]]) for _ in range(400)] + [np.full(999, 7), [1]]).astype("<u4")
    symbols, rules = repair_ids.compress(ids, 50, 2)
    assert len(symbols) < len(ids) / 4 and repair_ids.expand(symbols, rules, 50) == ids.tobytes()
    assert repair_ids.compress(ids[:0], 50)[0].size == 0
    shard = {
        "symbols": symbols.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(), "alphabet": 50,
        "lengths": repair_ids.expansion_lengths(rules, 50).astype("<u4").tobytes(),
    }
    for start, stop in ((0, 1), (17, 17), (100, 777), (len(ids) - 3, len(ids))):
        assert repair_ids.ids_between(shard, start, stop).tolist() == ids[start:stop].tolist()


def test_files_in_order(docs_of, spark, table_texts, tmp_path):
    library = Tokenizer.from_file(WORDS)
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    for n, (df, pairs) in enumerate(((docs_of(AWKWARD, CLASHES), AWKWARD), (table, table_texts))):
        path = str(tmp_path / f"shards{n}")
        repair_ids.write_shards(df, WORDS, path, shard_ids=500, min_count=2)
        got = sorted((tuple(r) for r in repair_ids.read_documents(spark, path).collect()), key=lambda r: r[1])
        start = 0
        assert [r[0] for r in got] == sorted((i for i, _ in pairs), key=lambda i: (i is not None, i))
        texts = {}
        for i, t in pairs:
            texts.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
        for doc, begin, size, crc in got:
            assert begin == start
            raw = [np.array(x, "<u4").tobytes() for x in texts[doc]]
            assert (size, crc) in [(len(r) // 4, zlib.crc32(r)) for r in raw]
            start += size
    empty = str(tmp_path / "none")
    repair_ids.write_shards(table.where("false"), WORDS, empty)
    assert repair_ids.read_documents(spark, empty).count() == 0


def test_counts_equal_the_library(docs_of):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    library = Tokenizer(Unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], 0, True))
    own = viterbi_counts.counter(MODEL)
    for text in ["  ", "a  b\n c", "日本語 🙂x\x00", "▁▁a"] + noise(2, "aeinst hTHé12!'\n日🙂", 1200):
        assert own.count(text)[0] == (len(library.encode("▁" + text.replace(" ", "▁")).ids) if text else 0)
    rows = viterbi_counts.token_counts(docs_of(AWKWARD, CLASHES), MODEL).collect()
    assert len(rows) == len(AWKWARD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}


def test_count_ties_keep_the_longer_last_piece():
    counter = viterbi_counts.UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0), ("c", -4.0), ("bc", -5.0)])
    assert counter.solve("ab") == (1, -2.0)
    assert counter.solve("abc")[1] == -6.0
    assert counter.solve("é") == (2, -15.0)


def test_new_pieces_are_asked_together_with_the_ids_of_each():
    own, library = repair_ids.PieceEncoder(WORDS), Tokenizer.from_file(WORDS)
    asked = []
    ask = own._ask
    own._ask = lambda texts: asked.append(len(texts)) or ask(texts)
    texts = [f"it's a{n}b word{chr(97 + n % 26)}, caf\u00e9{n}! (x_{n}) \u00aa\u00ba don't 'tis 3.14 {'?' * (n % 9)} __ \u00df''s" for n in range(300)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert sum(asked) < 5 and len(own.pieces) > 40
    pieces = ["caf\u00e9", "two words", "!"]  # no single piece: each is asked alone
    assert own._ask_pieces(pieces) == ask(pieces)


def test_no_pair_is_left_that_a_rule_could_replace():
    rng = np.random.default_rng(5)
    zipf = np.minimum(rng.zipf(1.2, 1 << 17) + 1, 40_000)
    runs = np.repeat(rng.integers(2, 99, 9000), rng.integers(1, 30, 9000))
    crossing = rng.permutation(np.tile([[2, 3, 4], [3, 4, 5], [4, 5, 2], [5, 2, 3]], (20, 1))).ravel()
    for ids, least in ((zipf, 16), (runs, 16), (crossing, 16), (rng.integers(1, 5, 3000), 2)):
        symbols, rules = repair_ids.compress(ids.astype("<u4"), 50_000, least)
        assert repair_ids.expand(symbols, rules, 50_000) == ids.astype("<u4").tobytes()
        uses, ended = {}, {}
        for at, pair in enumerate(zip(symbols.tolist(), symbols[1:].tolist())):
            if 1 not in pair and ended.get(pair, -1) < at:
                uses[pair], ended[pair] = uses.get(pair, 0) + 1, at + 1
        assert max(uses.values(), default=0) < least


def test_blocks_of_any_size_and_a_full_memory(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    texts = ["", "'", "a'", "'S's ''s x'LLy 've're'm 'd't", "caf\u00c9, CAF\u00c9! \u65e5\u672c", "\u65e5", " \n", "x<|y"] + noise(7, "'stdremvl SL1.\xc9\xdf\xa0\n", 400)
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(repair_ids, "REMEMBERED", 50)
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(repair_ids, "BLOCK_BYTES", size)
        assert [np.frombuffer(x, "<u4").tolist() for x in repair_ids.PieceEncoder(WORDS).encode(texts)] == want


def test_only_different_pieces_are_remembered_and_handled_one_by_one():
    own, words = repair_ids.PieceEncoder(WORDS), ["caf\u00e9", "word", "it"]
    seen = []
    learn = own._learn
    own._learn = lambda new: seen.extend(new) or learn(new)
    own.encode([" ".join(w + m for w in words for m in ("", ".", ",", "!", "...", "?!", "'s")) + " 31" for _ in range(50)])
    assert len(seen) == len(own.pieces) == 3 + 6 + 2
