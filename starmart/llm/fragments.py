"""Windows of a text dealt by content, so that equal windows meet in one shard.

The symbols of a document (bytes, or hashes of words) are hashed in runs of ``anchor``
symbols.  The anchor of a window is the place of its least such hash, the leftmost on a tie;
it depends on the window's content alone, so equal windows have equal anchors at equal
places.  Consecutive windows with the same anchor place form a fragment.  A window can
repeat only if its anchor's hash appears again, so only fragments with a repeated anchor
are looked at, and all that can hold equal windows share a shard.

Documents are worked off in packs of ``PACK_PARTS`` parts of a megabyte that are written to the
shared folder once, in buckets by pack: their texts never move again.  A pack is always cut
into the same fragments again, so a fragment is known by its number within the pack, and
what comes back to a pack is a bit for each window.  What a pack sends to a shard is one
row, so rows stay few beside what they hold.

An anchor that appears in very many packs would fill one shard.  Its windows are dealt one
by one, by the hash of the whole window, which spreads them evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import exact_dedup
from starmart.session import stage, stage_by

PACK_BYTES = 1 << 20  # text of a part, if its last document is not longer
PACK_PARTS = 8  # parts of a pack; a part is cut at a time
SHARDS_PER_PARTITION = 4  # shards of a shuffle partition; a task holds one of them at a time
HOT_PACKS = 4096  # an anchor in more parts than this has its windows dealt one by one
TOLD_BYTES = 6  # of an anchor, beside its shard, when repeated ones are looked for: equal ones cost work only
NO_ID = np.iinfo(np.int64).max  # stands for a null id: larger than any

_MULTIPLIERS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of ``length`` symbols from each place; runs double until the length is reached."""
    whole, done = None, 0
    level = mix(symbols.astype(np.uint64) + np.uint64(1))
    size, rest = 1, length
    while True:
        if rest & 1:
            if whole is None:
                whole, done = level, size
            else:
                # The shorter run goes in front; the order of the parts is fixed by the length.
                n = len(level) - done
                front = whole[: max(0, n)]
                whole = mix(front * _MULTIPLIERS[0] + level[done:][: len(front)] * _MULTIPLIERS[1])
                done += size
        rest >>= 1
        if not rest:
            return whole[: max(0, len(symbols) - length + 1)]
        n = max(0, len(level) - size)
        level = (level[:n] * _MULTIPLIERS[2]) ^ ((level[size:] + np.uint64(size)) * _MULTIPLIERS[3])
        level ^= level >> np.uint64(29)
        size *= 2


def _sliding_argmin(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` consecutive hashes (by their upper bits), the leftmost of equal ones."""
    low = np.uint64((1 << 32) - 1)  # the same for every pack: equal windows must agree on their anchor
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(hashes) - width + 1], least[width - size :])
    return (least & low).astype(np.int64)


@dataclass
class Cut:
    """Fragments of a pack: first window, number of windows and anchor hash of each, in order."""

    first: np.ndarray
    count: np.ndarray
    value: np.ndarray
    doc: np.ndarray  # number of the document within the pack


def cut(symbols: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> Cut:
    """``ends``: end of each document within ``symbols``.  Windows never span two documents."""
    nothing = np.zeros(0, np.int64)
    if len(symbols) < window:
        return Cut(nothing, nothing, nothing.astype(np.uint64), nothing)
    hashes = run_hashes(symbols, anchor)
    place = _sliding_argmin(hashes, window - anchor + 1)
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)[: len(place)]
    valid = np.arange(len(place)) + window <= ends[doc]
    at = np.flatnonzero(valid)
    if not len(at):
        return Cut(nothing, nothing, nothing.astype(np.uint64), nothing)
    own = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    begin = np.flatnonzero(new)
    # The least of some hashes is small; scattered again, anchors are dealt evenly.
    return Cut(at[begin], np.diff(begin, append=len(at)), mix(hashes[own[begin]]), doc[at[begin]])


# --- packs -----------------------------------------------------------------------------

PACK_SCHEMA = "pack long, doc_ids array<long>, digests array<string>, sizes array<long>, members array<long>, bodies array<binary>"


def write_packs(texts: DataFrame) -> DataFrame:
    """Packs of ``texts(doc_id long, digest string, text string)``, written once, in buckets by pack.

    ``members`` has the number of documents of each part, ``bodies`` their texts.
    """

    def pack(number: int, parts: list[tuple[list, list, list[int], bytes]]) -> pa.RecordBatch:
        ids, digests, sizes = ([x for part in parts for x in part[k]] for k in range(3))
        row = [number, [NO_ID if i is None else i for i in ids], digests, sizes, [len(p[0]) for p in parts], [p[3] for p in parts]]
        kinds = [pa.int64(), *[pa.list_(k) for k in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())]]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in PACK_SCHEMA.split(", ")]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, squeeze = TaskContext.get().partitionId() << 32, 0, zstandard.ZstdCompressor(level=1).compress
        ids, digests, bodies, parts = [], [], [], []
        for batch in batches:
            for i, d, t in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                body = (t or "").encode("utf-8", "replace")
                ids.append(i)
                digests.append(d)
                bodies.append(body)
                held += len(body)
                if held >= PACK_BYTES:
                    parts.append((ids, digests, list(map(len, bodies)), squeeze(b"".join(bodies))))
                    held, ids, digests, bodies = 0, [], [], []
                    if len(parts) == PACK_PARTS:
                        yield pack(number, parts)
                        number, parts = number + 1, []
        if ids:
            parts.append((ids, digests, list(map(len, bodies)), squeeze(b"".join(bodies))))
        if parts:
            yield pack(number, parts)

    return stage_by(texts.select("doc_id", "digest", "text").mapInArrow(run, PACK_SCHEMA), "pack", "packs")


def unpack(row: dict) -> list[list[bytes]]:
    """The documents' bytes of a pack, part by part."""
    loosen, out, at = zstandard.ZstdDecompressor(), [], 0
    for members, squeezed in zip(row["members"], row["bodies"]):
        sizes = row["sizes"][at : at + members]
        body = memoryview(loosen.decompress(squeezed, max_output_size=max(1, sum(sizes))))
        ends = np.cumsum([0, *sizes]).tolist()
        out.append([bytes(body[a:b]) for a, b in zip(ends, ends[1:])])
        at += members
    return out


# --- repeated anchors ------------------------------------------------------------------

@dataclass
class Reading:
    """How documents are read: their symbols, the window, the anchor, and whether repeats inside a document count."""

    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # of a pack's documents: symbols and ends
    window: int
    anchor: int
    within: bool


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):  # one pack at a time
            yield batch.slice(k, 1).to_pylist()[0]


@dataclass
class Open:
    """A pack's documents as symbols, part by part, and their cuts."""

    parts: list[list[bytes]]
    symbols: list[np.ndarray]
    ends: list[np.ndarray]
    cuts: list[Cut]

    def offsets(self, of: list[np.ndarray]) -> list[int]:
        """Where each part begins if its rows follow those of the parts before it."""
        return np.cumsum([0, *map(len, of)]).tolist()


def opened(row: dict, reading: Reading) -> Open:
    parts = unpack(row)
    read = [reading.symbols(part) for part in parts]
    cuts = [cut(symbols, ends, reading.window, reading.anchor) for symbols, ends in read]
    return Open(parts, [r[0] for r in read], [r[1] for r in read], cuts)


def _distinct(pack: Open) -> tuple[np.ndarray, np.ndarray]:
    """The pack's different anchors in order, and for each fragment its anchor's number."""
    return np.unique(np.concatenate([c.value for c in pack.cuts]), return_inverse=True)


def _repeats(pack: Open, values: np.ndarray, number: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each of the pack's anchors the number of parts that have it, and whether it repeats inside the pack."""
    at = np.cumsum([len(c.value) for c in pack.cuts])[:-1]
    parts = np.bincount(np.concatenate([np.unique(own) for own in np.split(number, at)]), minlength=len(values))
    if within:
        return parts, np.bincount(number, minlength=len(values)) > 1
    doc = np.concatenate([c.doc + begin for c, begin in zip(pack.cuts, pack.offsets(pack.ends))])
    low, high = np.full(len(values), NO_ID), np.full(len(values), -1)
    np.minimum.at(low, number, doc)
    np.maximum.at(high, number, doc)
    return parts, high > low


def _shard_bounds(values: np.ndarray, shards: int) -> np.ndarray:
    """Values are dealt to shards by range: hashes are even, and a pack's sorted values stay sorted."""
    edges = (np.arange(1, shards, dtype=np.uint64) * np.uint64((1 << 64) // shards)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def shard_count(df: DataFrame) -> int:
    return SHARDS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def repeated_anchors(packs: DataFrame, reading: Reading, shards: int) -> DataFrame:
    """(pack, parts): for each shard two bit rows over the pack's anchors in it: repeated, and hot (empty if none is)."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            pack = opened(row, reading)
            values, number = _distinct(pack)
            parts, again = _repeats(pack, values, number, reading.within)
            bounds = _shard_bounds(values, shards)
            used = np.flatnonzero(np.diff(bounds))
            told = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOLD_BYTES].tobytes()
            marks = (parts * 2 + again).astype(np.uint8).tobytes()
            spans = list(zip(bounds[used].tolist(), bounds[used + 1].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int32()), pa.array([row["pack"]] * len(used), pa.int64()),
                    pa.array([told[a * TOLD_BYTES : b * TOLD_BYTES] for a, b in spans], pa.binary()),
                    pa.array([squeeze(marks[a:b]) for a, b in spans], pa.binary()),
                ],
                names=["shard", "pack", "anchors", "marks"],
            )

    def settle(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        loosen = zstandard.ZstdDecompressor()
        ends = np.cumsum([0, *[len(v) // TOLD_BYTES for v in group["anchors"]]]).tolist()
        told = np.zeros((ends[-1], 8), np.uint8)
        told[:, :TOLD_BYTES] = np.frombuffer(b"".join(group["anchors"]), np.uint8).reshape(-1, TOLD_BYTES)
        marks = np.frombuffer(b"".join(loosen.decompress(m) for m in group["marks"]), np.uint8)
        different, number = np.unique(told.view("<u8").ravel(), return_inverse=True)
        parts = np.bincount(number, weights=marks >> 1, minlength=len(different))
        again = np.bincount(number, weights=marks & 1, minlength=len(different)) > 0
        repeated, hot = ((parts > 1) | again)[number], (parts > HOT_PACKS)[number]
        out = [(np.packbits(repeated[a:b]).tobytes(), np.packbits(hot[a:b]).tobytes() if hot[a:b].any() else b"") for a, b in zip(ends, ends[1:])]
        return pd.DataFrame({
            "pack": group["pack"], "shard": key[0], "n": np.diff(ends), "repeated": [r for r, _ in out], "hot": [h for _, h in out],
        })

    emitted = packs.select("pack", "sizes", "members", "bodies").mapInArrow(emit, "shard int, pack long, anchors binary, marks binary")
    settled = emitted.groupBy("shard").applyInPandas(settle, "pack long, shard int, n long, repeated binary, hot binary")
    return settled.groupBy("pack").agg(F.collect_list(F.struct("shard", "n", "repeated", "hot")).alias("parts"))


def _flags(parts: list[dict] | None, name: str, size: int) -> np.ndarray:
    own = sorted(parts or [], key=lambda p: p["shard"])
    bits = [np.unpackbits(np.frombuffer(p[name], np.uint8), count=p["n"]) if p[name] else np.zeros(p["n"], np.uint8) for p in own]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(size, bool)


@dataclass
class Chosen:
    """Fragments of a pack that may repeat, and their different contents in the order of the shards."""

    first: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    content: np.ndarray  # number of the fragment's content
    lead: np.ndarray  # for each content its earliest fragment
    value: np.ndarray  # for each content the hash that deals it


def choose(pack: Open, doc_ids: np.ndarray, parts: list[dict] | None, reading: Reading) -> Chosen:
    """Places and document numbers are those of all the pack's parts in a row."""
    values, number = _distinct(pack)
    repeated, hot = _flags(parts, "repeated", len(values))[number], _flags(parts, "hot", len(values))[number]
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    begins, docs, cuts = pack.offsets(pack.symbols), pack.offsets(pack.ends), pack.offsets([c.value for c in pack.cuts])
    for k, (symbols, found) in enumerate(zip(pack.symbols, pack.cuts)):
        own_repeated, own_hot = repeated[cuts[k] : cuts[k + 1]], hot[cuts[k] : cuts[k + 1]]
        plain, single = np.flatnonzero(own_repeated & ~own_hot), np.flatnonzero(own_repeated & own_hot)
        first, count, doc, value = (c[plain] for c in (found.first, found.count, found.doc, found.value))
        if len(single):
            n = found.count[single]
            at = np.repeat(found.first[single] - np.cumsum(n) + n, n) + np.arange(n.sum())
            whole = run_hashes(symbols, reading.window)
            first, count = np.concatenate([first, at]), np.concatenate([count, np.ones(len(at), np.int64)])
            doc, value = np.concatenate([doc, np.repeat(found.doc[single], n)]), np.concatenate([value, whole[at]])
        if not len(first):
            continue
        # Same content: same anchor, same length, same hash over all of it.
        sums = np.concatenate([[0], np.cumsum(mix(symbols.astype(np.uint64) + np.uint64(7)) * _powers(len(symbols)), dtype=np.uint64)])
        last = first + count + reading.window - 1
        body = (sums[last] - sums[first]) * _inverse_powers(len(symbols) + 1)[first]
        for column, own in zip(columns, (first + begins[k], count, doc + docs[k], value, body)):
            column.append(own)
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    first, count, doc, value, body = (np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(columns, kinds))
    order = np.lexsort([first, doc_ids[doc], body, count, value]) if len(first) else np.zeros(0, np.int64)
    new = np.ones(len(order), bool)
    if len(order):
        sorted_keys = [key[order] for key in (value, count, body)]
        new[1:] = np.any([key[1:] != key[:-1] for key in sorted_keys], axis=0)
    content = np.empty(len(order), np.int64)
    content[order] = np.cumsum(new) - 1
    lead = order[new]
    return Chosen(first, count, doc, content, lead, value[lead])


_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse_powers(n: int) -> np.ndarray:
    return _powers(n, _BASE_INVERSE)


# --- shards ----------------------------------------------------------------------------

def _pack_bits(bits: list[np.ndarray]) -> bytes:
    return np.packbits(np.concatenate(bits)).tobytes() if bits else b""


def deal_fragments(packs: DataFrame, anchors: DataFrame, reading: Reading, shards: int) -> DataFrame:
    """(shard, pack, n, ..): the different contents of a pack that go to a shard, each with its earliest place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            pack, ids = opened(row, reading), np.array(row["doc_ids"], np.int64)
            got = choose(pack, ids, row["parts"], reading)
            symbols = np.concatenate(pack.symbols)
            bounds = _shard_bounds(got.value, shards)
            used = np.flatnonzero(np.diff(bounds))
            begins = np.concatenate([np.concatenate([[0], ends[:-1]]) + at for ends, at in zip(pack.ends, pack.offsets(pack.symbols))])
            columns: dict[str, list] = {k: [] for k in ("contents", "counts", "ids", "places", "anchors")}
            for s in used:
                lead = got.lead[bounds[s] : bounds[s + 1]]
                first, n = got.first[lead], got.count[lead] + reading.window - 1
                at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                columns["contents"].append(squeeze(symbols[at].tobytes()))
                columns["counts"].append(squeeze(got.count[lead].astype("<u2").tobytes()))
                columns["ids"].append(squeeze(ids[got.doc[lead]].astype("<i8").tobytes()))
                columns["places"].append(squeeze((first - begins[got.doc[lead]]).astype("<i8").tobytes()))
                # Contents of equal names are only looked at together, whatever their anchors.
                columns["anchors"].append(got.value[bounds[s] : bounds[s + 1]].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([row["pack"]] * len(used), pa.int64()), *[pa.array(v, pa.binary()) for v in columns.values()]],
                names=["shard", "pack", *columns],
            )

    joined = packs.join(anchors, "pack").select("pack", "doc_ids", "sizes", "members", "bodies", "parts")
    return joined.mapInArrow(run, "shard int, pack long, contents binary, counts binary, ids binary, places binary, anchors binary")


@dataclass
class Shard:
    """Fragments of a shard, content after content: symbols with their ends, number of windows, place of the earliest."""

    symbols: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    places: np.ndarray
    anchors: np.ndarray


def verdicts(dealt: DataFrame, reading: Reading, kind: str, judge: Callable[[Shard], list[np.ndarray]]) -> DataFrame:
    """(pack, parts): for each shard a bit for each window of the pack's contents: does it appear earlier?

    ``judge`` gets the shard's fragments that may share windows with another one and says
    for each of their windows whether it appears in an earlier one.
    """

    def settle(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        loosen = zstandard.ZstdDecompressor()

        def column(name: str, dtype: str) -> list[np.ndarray]:
            return [np.frombuffer(loosen.decompress(v), dtype) for v in group[name]]

        counts = column("counts", "<u2")
        sizes = [len(c) for c in counts]
        counts = np.concatenate(counts).astype(np.int64)
        symbols = np.concatenate(column("contents", kind))
        ids, places = np.concatenate(column("ids", "<i8")), np.concatenate(column("places", "<i8"))
        anchors = np.frombuffer(b"".join(group["anchors"]), "<u4")
        lengths = counts + reading.window - 1
        ends = np.cumsum(lengths)
        begins = ends - lengths
        # Equal contents of several packs: the earliest stands for all.
        bodies = [symbols[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
        order = sorted(range(len(bodies)), key=lambda k: (anchors[k], bodies[k], ids[k], places[k]))
        earlier = [np.zeros(c, bool) for c in counts.tolist()]
        leads, kin = [], 0
        for k, at in enumerate(order):
            before = order[k - 1] if k else None
            if before is not None and anchors[at] == anchors[before] and bodies[at] == bodies[before]:
                first = leads[-1]
                if reading.within or ids[at] > ids[first]:
                    earlier[at][:] = True
            else:
                leads.append(at)
        # A content whose anchor no other content has shares no window with another.
        shared = np.array(leads, np.int64)
        same = np.zeros(len(shared), bool)
        if len(shared):
            own = anchors[shared]
            same[1:] |= own[1:] == own[:-1]
            same[:-1] |= own[1:] == own[:-1]
        shared = shared[same]
        if len(shared):
            shared = shared[np.lexsort([places[shared], ids[shared]])]
            n = lengths[shared]
            pick = np.repeat(begins[shared] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found = judge(Shard(symbols[pick], np.cumsum(n), counts[shared], ids[shared], places[shared], anchors[shared]))
            for at, bits in zip(shared.tolist(), found):
                earlier[at] |= bits
            if not reading.within:
                # Equal contents of one document in two packs can't be; of equal ids they have one verdict.
                for k, at in enumerate(order[1:], 1):
                    before = order[k - 1]
                    if bodies[at] == bodies[before] and anchors[at] == anchors[before] and ids[at] == ids[before]:
                        earlier[at] |= earlier[before]
        out, at = [], 0
        for size in sizes:
            out.append(_pack_bits(earlier[at : at + size]))
            at += size
        return pd.DataFrame({"pack": group["pack"], "shard": key[0], "bits": out})

    settled = dealt.groupBy("shard").applyInPandas(settle, "pack long, shard int, bits binary")
    return settled.groupBy("pack").agg(F.collect_list(F.struct("shard", "bits")).alias("found"))


def earlier_windows(row: dict, pack: Open, reading: Reading, shards: int) -> list[np.ndarray]:
    """For each part a boolean for each of its symbols: does a window that begins here appear earlier?"""
    ids = np.array(row["doc_ids"], np.int64)
    got = choose(pack, ids, row["parts"], reading)
    begins = pack.offsets(pack.symbols)
    out = np.zeros(begins[-1], bool)
    if not len(got.first):
        return np.split(out, begins[1:-1])
    counts = got.count[got.lead]
    per_content = np.concatenate([[0], np.cumsum(counts)])
    bits = np.zeros(per_content[-1], bool)
    bounds = _shard_bounds(got.value, shards)
    for part in row["found"] or []:
        a, b = per_content[bounds[part["shard"]]], per_content[bounds[part["shard"] + 1]]
        bits[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a)
    n = got.count
    windows = np.repeat(got.first - np.cumsum(n) + n, n) + np.arange(n.sum())
    inside = np.repeat(per_content[got.content] - np.cumsum(n) + n, n) + np.arange(n.sum())
    lead = got.lead[got.content]
    later = ids[got.doc] > ids[got.doc[lead]]
    if reading.within:
        later |= (got.doc == got.doc[lead]) & (got.first > got.first[lead])
    out[windows] = np.repeat(later, n) | bits[inside]
    return np.split(out, begins[1:-1])


def over_documents(
    docs: DataFrame, reading: Reading, kind: str, judge: Callable[[Shard], list[np.ndarray]],
    finish: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], dict[str, list]], schema: str,
) -> tuple[DataFrame, DataFrame]:
    """(marks, firsts): the exact copies of ``docs(doc_id, text)``, and a row by ``finish`` for each different text.

    Equal texts are settled first, so a group of copies is one document here.  ``finish``
    gets a pack's documents, their symbols with ends, and where windows that appear earlier
    begin; its columns follow ``digest`` in ``schema``.
    """
    raw = lambda text: F.sha2(F.coalesce(text, F.lit("")), 256)
    marks = stage(exact_dedup.mark_duplicates(docs, key=raw), "copies")
    texts = exact_dedup.keep_first(docs, key=raw).withColumn("digest", raw(F.col("text")))
    packs = write_packs(texts)
    shards = shard_count(docs)
    anchors = stage(repeated_anchors(packs, reading, shards), "anchors")
    found = stage(verdicts(deal_fragments(packs, anchors, reading, shards), reading, kind, judge), "verdicts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pack = opened(row, reading)
            docs_before = pack.offsets(pack.ends)
            for k, earlier in enumerate(earlier_windows(row, pack, reading, shards)):
                digests = row["digests"][docs_before[k] : docs_before[k + 1]]
                yield pa.RecordBatch.from_pydict({"digest": digests, **finish(pack.parts[k], pack.symbols[k], pack.ends[k], earlier)})

    # A pack of short texts has neither.
    joined = packs.join(anchors, "pack", "left").join(found, "pack", "left")
    joined = joined.select("doc_ids", "digests", "sizes", "members", "bodies", "parts", "found")
    return marks, stage(joined.mapInArrow(run, f"digest string, {schema}"), "firsts")
