"""Token ids in a compressed file format: Re-Pair grammars by shard.

Documents are dealt by ranges of their id, so the shards of partition 0, 1, 2 .. hold them
in order.  A shard is one row of a Parquet table: about ``SHARD_IDS`` ids as a sequence of
symbols, the rules of its grammar, the expansion length of each rule, and where each
document's symbols begin.  Pairs never span two documents, so a document, or any range of
its ids, is decoded without touching the rest of the shard.

Re-Pair replaces frequent pairs of ids by new symbols again and again.  A round here takes
all pairs that are frequent enough at once (overlaps go to the left one; a rule that then
replaces too few pairs is not made), lowers the bar, and the last one leaves no pair that
could be replaced ``min_count`` times.

Defined results: a null text is encoded as the empty one, so its document is the end id
alone.  A null document id comes before all others; equal ids are ordered by the text's
hash.  An empty table gives no shards and no rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import only
from starmart.session import new_path

END_ID = 1
SHARD_IDS = 1 << 20
MIN_COUNT = 16  # a rule replaces at least so many pairs of its shard
REMEMBERED = 800_000  # pieces kept in a worker
BLOCK_BYTES = 8 << 20  # of plain texts cut at a time
TOGETHER = 4096  # new pieces given to the tokenizer as one text
SLOTS = 1 << 16  # at least, of the table in which a round counts pairs
STEP = 64  # a round takes pairs down to this part of the most frequent one's uses

# --- grammar ---------------------------------------------------------------------------


def _leftmost(overlaps: np.ndarray) -> np.ndarray:
    """Of runs of places, each overlapping the next, every second one from the left."""
    first = np.append(True, ~overlaps)
    order = np.arange(len(first))
    begin = np.maximum.accumulate(np.where(first, order, 0))
    return np.flatnonzero((order - begin) & 1 == 0)


def compress(ids: np.ndarray, alphabet: int, min_count: int = MIN_COUNT, slots: int = SLOTS):
    """(symbols, rules): the shard's sequence, and for symbol alphabet + k its two halves rules[k].

    A round counts one pair in each slot of a table.  All places of a pair come to be in one
    round, so a pair that is found too rare stays so: its places are left out from then on, and
    the pairs that share its slot have their turn.  Where pairs that overlap take each other's
    places until none has enough, half of them are tried at a time, or less, down to one.
    """
    n = len(ids)
    slots = max(slots, 1 << (n >> 4).bit_length())
    symbols = np.append(ids, [END_ID]).astype(np.int64)  # an end beyond the last place is also before the first
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    ends = symbols == END_ID
    pairs = symbols << 32
    pairs[:-1] |= symbols[1:]
    alive = np.zeros(n + 1, bool)  # places whose pair may yet be replaced
    alive[:-1] = ~(ends[:-1] | ends[1:])
    there = np.ones(n, bool)
    keeper, some = np.empty(slots, np.int64), np.empty(slots, np.int64)
    rules, made, bar, mask = [], alphabet, np.inf, 0
    live = np.flatnonzero(alive)
    while len(live):
        size = min(slots, 1 << len(live).bit_length())
        codes = pairs.take(live)
        slot = codes * -7046029254386353131
        slot >>= 40
        slot &= size - 1
        keeper[slot] = codes
        own = keeper.take(slot) == codes
        counts = np.bincount(np.where(own, slot, size), minlength=size + 1)[:size]
        bar = max(min_count, min(bar, counts.max() / STEP))
        chosen = counts >= bar
        if mask:
            chosen &= (np.arange(size) ^ counts.argmax()) & mask == 0
        state = (chosen.astype(np.int8) - (counts < min_count)).take(slot) * own
        alive[live] = state >= 0
        picked = np.flatnonzero(state > 0)
        at, slot = live[picked], slot[picked]
        overlaps = after[at[:-1]] == at[1:]
        taken = _leftmost(overlaps) if len(at) else at
        used = np.bincount(slot[taken], minlength=size) >= min_count
        settled = ~used  # too rare when only places of their own are in the way
        crossed = np.flatnonzero(overlaps)
        crossed = crossed[slot[crossed] != slot[crossed + 1]]
        settled[slot[crossed]] = settled[slot[crossed + 1]] = False
        rare = settled[slot]
        alive[at[rare]] = False
        at, slot = at[taken], slot[taken]
        enough = used[slot]
        at, slot = at[enough], slot[enough]
        if len(at):
            some[slot] = at  # a place of each slot's pair
            first = some[np.flatnonzero(used)]
            rules.append(np.stack([symbols[first], symbols[after[first]]], axis=1))
            gone = after.take(at)
            follow = after.take(gone)
            new = (made - 1 + np.cumsum(used)).take(slot)
            made += len(first)
            symbols[at] = new
            there[gone] = alive[gone] = False
            after[at], before[follow] = follow, at
            prior = before.take(at)
            left, right = symbols.take(prior), symbols.take(follow)
            pairs[at], pairs[prior] = new << 32 | right, left << 32 | new
            alive[at], alive[prior] = right != END_ID, left != END_ID
            mask &= 1
        elif bar > min_count:
            bar = max(min_count, bar / STEP)
        elif rare.any():
            mask &= 1
        else:
            mask = (mask << 1 | 1) & slots - 1
        live = np.flatnonzero(alive)
    return symbols[:n][there], np.concatenate(rules) if rules else np.empty((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, alphabet: int) -> np.ndarray:
    lengths: list[int] = []
    for left, right in rules.tolist():
        lengths.append(
            (1 if left < alphabet else lengths[left - alphabet]) + (1 if right < alphabet else lengths[right - alphabet])
        )
    return np.array(lengths, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, alphabet: int) -> bytes:
    """All ids of a shard as little-endian 32-bit integers."""
    out: list[bytes] = []
    for left, right in rules.tolist():
        first = left.to_bytes(4, "little") if left < alphabet else out[left - alphabet]
        out.append(first + (right.to_bytes(4, "little") if right < alphabet else out[right - alphabet]))
    # One table of all expansions; a plain id stands at its own place in it.
    table = np.concatenate([np.arange(alphabet, dtype="<u4"), np.frombuffer(b"".join(out), "<u4")])
    size = np.concatenate([np.ones(alphabet, np.int64), np.fromiter(map(len, out), np.int64, len(out)) // 4])
    begin = np.cumsum(size) - size
    lengths = size[symbols]
    at = np.repeat(begin[symbols] - np.cumsum(lengths) + lengths, lengths)
    at += np.arange(len(at))
    return table.take(at).tobytes()


def ids_between(shard: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard: only the symbols that overlap the range are expanded."""
    symbols, rules = np.frombuffer(shard["symbols"], "<u4"), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    lengths, alphabet = np.frombuffer(shard["lengths"], "<u4"), shard["alphabet"]
    own = np.ones(len(symbols), np.int64)
    own[symbols >= alphabet] = lengths[symbols[symbols >= alphabet] - alphabet]
    ends = np.cumsum(own)
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    out: list[int] = []
    todo = symbols[lo:hi][::-1].tolist()
    while todo:
        s = todo.pop()
        if s < alphabet:
            out.append(s)
        else:
            left, right = rules[s - alphabet].tolist()
            todo += [right, left]
    skipped = int(ends[lo] - own[lo]) if lo < len(ends) else start
    return np.array(out[start - skipped : stop - skipped], dtype=np.uint32)


# --- encoding --------------------------------------------------------------------------

# A plain text has one byte for each letter: Latin-1 without those on which re and Unicode's classes differ.
_ODD = b"\x1c\x1d\x1e\x1f\xb2\xb3\xb9\xbc\xbd\xbe"
_PLAIN = bytes(b for b in range(256) if b not in _ODD)
_LOWER = bytes(ord(chr(b).lower()) for b in range(256))
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_KINDS = bytes(
    _SPACE if c.isspace() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _MARK for c in map(chr, range(256))
)
_SPACES = bytes(b for b in range(256) if _KINDS[b] == _SPACE)
# Byte-level vocabularies spell visible Latin-1 bytes as themselves, the others in order from U+0100; these are of letters.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE) if b >= 0x80}


def _plain(text: str) -> bytes | None:
    """A plain text in Latin-1."""
    if "<|" in text:
        return None
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if raw.translate(None, _PLAIN) else raw


def _cut(low: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the pieces of lower-case plain text that ends in a space.

    They are the tokenizer's own: 's 't 're 've 'm 'll 'd where no other mark is before, runs of
    letters, single digits, runs of marks.
    """
    data, kinds = np.frombuffer(low, np.uint8), np.frombuffer(low.translate(_KINDS), np.uint8)
    begins = kinds == _DIGIT
    begins[0] = True
    begins[1:] |= kinds[1:] != kinds[:-1]
    short = np.flatnonzero(data == ord("'"))
    short = short[begins[short]]
    second, third = data[short + 1], data[np.minimum(short + 2, len(data) - 1)]
    one = np.isin(second, np.frombuffer(b"stmd", np.uint8))
    two = (np.isin(second, np.frombuffer(b"rv", np.uint8)) & (third == ord("e"))) | ((second == ord("l")) & (third == ord("l")))
    begins[short[one | two] + 1] = False
    begins[short[one] + 2] = True
    begins[short[two] + 3] = True
    seen = kinds != _SPACE
    at = np.flatnonzero(begins & seen)
    return at, np.flatnonzero(begins[1:] & seen[:-1]) + 1 - at


class PieceEncoder:
    """Ids of a text from the tokenizers library, which is asked once for each different piece.

    Plain texts are cut as the tokenizer cuts them, a block of them at a time, and the ids of
    a text's pieces are its own.  Pieces are remembered in a dictionary of bounded size.  Any
    other text is given to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pieces: dict[bytes, bytes] = {}
        self.alphabet = self.library.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.zeros(self.alphabet, bool)
        self.ends_word[[n for token, n in self.library.get_vocab().items() if token.endswith(self.library.model.end_of_word_suffix or "\n")]] = True

    def _ask(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _ask_pieces(self, pieces: list[str]) -> list[bytes]:
        """As ``_ask``, for pieces of plain texts: many make one text, whose ids part after those that end a word."""
        out: list[bytes] = []
        for k in range(0, len(pieces), TOGETHER):
            some = pieces[k : k + TOGETHER]
            raw = self._ask([" ".join(some)])[0]
            stops = ((np.flatnonzero(self.ends_word[np.frombuffer(raw, "<u4")]) + 1) * 4).tolist()
            whole = len(stops) == len(some) and stops[-1] == len(raw)
            out += [raw[b:e] for b, e in zip([0, *stops], stops)] if whole else self._ask(some)
        return out

    def _learn(self, new: list[bytes]) -> None:
        """Remembers new pieces; the library's model can be given those of letters at once, in its own spelling of bytes."""
        tokens = self.library.model.tokenize
        letters = [p for p in new if _KINDS[p[0]] == _LETTER]
        spelt = b"\n".join(letters).decode("latin-1").encode().decode("latin-1")
        for byte, letter in _BYTE_LETTERS.items():
            spelt = spelt.replace(chr(byte), chr(letter))
        self.pieces.update((p, array("I", [t.id for t in tokens(s)]).tobytes()) for p, s in zip(letters, spelt.split("\n")))
        other = [p for p in new if _KINDS[p[0]] != _LETTER]
        self.pieces.update(zip(other, self._ask_pieces([p.decode("latin-1") for p in other])))

    def _block(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain texts."""
        low = b" ".join([*texts, b""]).translate(_LOWER)
        at, sizes = _cut(low)
        ends = np.cumsum([len(t) + 1 for t in texts])
        if not len(at):
            return [b""] * len(texts)
        borders = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        letters = pa.py_buffer(low.translate(None, _SPACES))
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, borders, letters]).dictionary_encode()
        codes = coded.indices.to_numpy()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        known = list(map(self.pieces.get, different))
        new = [k for k, ids in enumerate(known) if ids is None]
        self._learn([different[k] for k in new])
        for k in new:
            known[k] = self.pieces[different[k]]
        table = np.frombuffer(b"".join(known), "<u4")
        lengths = np.fromiter(map(len, known), np.int32, len(known)) // 4
        size = lengths[codes]
        stops = np.cumsum(size, dtype=np.int32)
        step = (np.cumsum(lengths, dtype=np.int32) - lengths)[codes] - stops + size  # from a place in the text to that in the table
        places = np.repeat(step, size)
        places += np.arange(len(places), dtype=np.int32)
        raw = table.take(places).tobytes()
        ends = (4 * np.concatenate([[0], stops])[np.searchsorted(at, ends)]).tolist()
        return [raw[b:e] for b, e in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """A block of ``BLOCK_BYTES`` of plain texts (or one longer text) is worked on at a time."""
        out: list[bytes] = []
        block, held, odd = [], 0, {}

        def done():
            found = self._block(block) if block else []
            for k, whole in odd.items():
                found[k] = whole
            block.clear()
            odd.clear()
            out.extend(found)

        for text in texts:
            raw = _plain(text)
            if raw is None:
                odd[len(block)] = self._ask([text])[0]
            block.append(raw or b"")
            held += len(block[-1]) + 1
            if held >= BLOCK_BYTES:
                done()
                held = 0
        done()
        return out


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for all tasks of a Python worker."""
    return PieceEncoder(path)


# --- files -----------------------------------------------------------------------------

SHARD_SCHEMA = (
    "part int, shard int, ids_before long, n_ids long, alphabet int, doc_ids {kind}, doc_sizes array<long>, "
    "symbols binary, rules binary, lengths binary"
)


def write_shards(
    docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
    shard_ids: int = SHARD_IDS, min_count: int = MIN_COUNT,
) -> None:
    """Write the ids of ``docs``, each document ended by ``END_ID``, in ascending order of the document id."""
    source = only(docs, doc_id=id_col, text=text_col)
    id_type = pa.list_(pa.int64() if source.schema["doc_id"].dataType.simpleString() != "string" else pa.string())

    def shard(part: int, number: int, before: int, names: list, pieces: list[bytes], alphabet: int) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(pieces), dtype="<u4")
        symbols, rules = compress(ids, alphabet, min_count)
        row = [
            part, number, before, len(ids), alphabet, names, [len(p) // 4 for p in pieces], symbols.astype("<u4").tobytes(),
            rules.astype("<u4").tobytes(), expansion_lengths(rules, alphabet).astype("<u4").tobytes(),
        ]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), id_type, pa.list_(pa.int64()), *[pa.binary()] * 3]
        columns = [s.split()[0] for s in SHARD_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held = TaskContext.get().partitionId(), 0, 0, 0
        encoder = piece_encoder(tokenizer_path)
        names, pieces, end = [], [], END_ID.to_bytes(4, "little")
        for batch in batches:
            found = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            for name, ids in zip(batch.column(0).to_pylist(), found):
                names.append(name)
                pieces.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= shard_ids:
                    yield shard(part, number, before, names, pieces, encoder.alphabet)
                    number, before, held, names, pieces = number + 1, before + held, 0, [], []
        if pieces:
            yield shard(part, number, before, names, pieces, encoder.alphabet)

    kind = "array<string>" if id_type == pa.list_(pa.string()) else "array<long>"
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    if kind == "array<long>":
        source = source.withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, SHARD_SCHEMA.format(kind=kind)).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and with ``ids`` the ids) from shard files.

    One row for each partition, at most as many as tasks have written, is summed up in
    order and broadcast.
    """
    shards = spark.read.parquet(path)
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_start"))
    text_ids = dict(shards.dtypes)["doc_ids"] == "array<string>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = expand(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["rules"], "<u4").reshape(-1, 2), row["alphabet"])
                ends = np.cumsum(row["doc_sizes"]).tolist()
                begins = [0, *ends[:-1]]
                crcs = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins, ends)]
                offset = row["part_start"] + row["ids_before"]
                arrays = [
                    pa.array(row["doc_ids"], pa.string() if text_ids else pa.int64()),
                    pa.array([offset + b for b in begins], pa.int64()),
                    pa.array(row["doc_sizes"], pa.int64()), pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    whole = np.frombuffer(raw, "<u4")
                    arrays.append(pa.array([whole[b:e] for b, e in zip(begins, ends)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {'string' if text_ids else 'long'}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    placed = shards.join(F.broadcast(starts), "part").select(
        "part_start", "ids_before", "alphabet", "doc_ids", "doc_sizes", "symbols", "rules"
    )
    return placed.mapInArrow(run, schema)


def write_and_read(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    path = new_path(docs.sparkSession, "token-shards")
    write_shards(docs, tokenizer_path, path, id_col, text_col)
    return read_documents(docs.sparkSession, path)
