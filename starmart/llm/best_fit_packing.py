"""Packing of token sequences by bounded-space online best fit.

Every document's ids (with an end id) are cut into pieces of at most ``capacity`` ids, the
odd rest first, and each piece is put, as it comes, into the open bin that it fills best
(of ``WINDOW`` pieces that come together, the longest first).  A task has at most ``open_bins`` open bins: their free spaces are the bits of one integer,
so the best bin is its lowest set bit at or above the piece's length; when a piece fits
nowhere and no further bin may be opened, the fullest bin closes.

Bins still open when a task ends are not lost half empty: they go, as items, through the
same packing again, those of ``FAN_IN`` tasks together, then of FAN_IN times FAN_IN, until
one task is left.  A round's task sees at most FAN_IN * open_bins bins, whatever the input,
and leaves at most open_bins open: again the fullest close first.

Defined results: a null text is the empty one, whose only id is the end id; rows with a null
or repeated id are packed like any others; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import only
from starmart.llm.library_ids import word_ids
from starmart.session import stage

END_ID = 2
CAPACITY = 1024
OPEN_BINS = 256
FAN_IN = 8
WINDOW = 1024
_BIN_BITS = 40  # of a sequence id: the task above, its bin below


class BestFit:
    """Open bins by free space; ``put`` returns (bin, place) of an item."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = self.count = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        self.count -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.count == self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
            self.by_free[left].append(found)
            self.mask |= 1 << left
            self.count += 1
        return found, self.capacity - free

    def still_open(self) -> dict[int, int]:
        """Fill of each open bin."""
        return {b: self.capacity - free for free, bins in enumerate(self.by_free) for b in bins}


def cut(n_ids: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: all but the first are full."""
    start, length = 0, (n_ids - 1) % capacity + 1
    while start < n_ids:
        yield start, length
        start, length = start + length, capacity


PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, task int, open_fill long"
)


def place_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces as each task packs them, and one row (piece -1) for each bin that it leaves open."""
    source = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    end = end_id.to_bytes(4, "little")
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int64()]

    def rows(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder = TaskContext.get().partitionId(), word_ids(tokenizer_path)
        packer = BestFit(capacity, open_bins)
        base = task << _BIN_BITS
        for batch in batches:
            encoded = encoder.encode(pc.fill_null(batch.column(1), ""))
            pieces = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    pieces.append((doc, number, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            out = []
            for k in range(0, len(pieces), WINDOW):
                for piece in sorted(pieces[k : k + WINDOW], key=lambda p: -p[3]):
                    found, offset = packer.put(piece[3])
                    out.append((*piece, base + found, offset, task, None))
            if out:
                yield rows(list(zip(*out)))
        left = packer.still_open()
        if left:
            none = [None] * len(left)
            yield rows([
                none, [-1] * len(left), *[none] * 3, [base + b for b in left], none, [task] * len(left), list(left.values()),
            ])

    return source.mapInArrow(run, PIECES)


_MEMBER = "members array<struct<bin: long, shift: long>>"


def merge_open(bins: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """(sequence_id, target, shift): where the rows of open ``bins(task, bin, fill)`` go in the end."""
    level = stage(
        bins.select("task", "fill", F.array(F.struct("bin", F.lit(0).cast("long").alias("shift"))).alias("members")), "open-bins"
    )
    closed = []

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        packer = BestFit(capacity, FAN_IN * open_bins)
        group = group.assign(first=[m[0]["bin"] for m in group.members]).sort_values(["fill", "first"], ascending=[False, True])
        made: dict[int, list] = {}
        fills: dict[int, int] = {}
        for fill, members in zip(group.fill.tolist(), group.members):
            found, offset = packer.put(fill)
            made.setdefault(found, []).extend((m["bin"], m["shift"] + offset) for m in members)
            fills[found] = offset + fill
        left = set(sorted(packer.still_open(), key=fills.get)[:open_bins])
        return pd.DataFrame({
            "task": int(group.task.iloc[0]) // FAN_IN, "fill": list(fills.values()),
            "members": [[{"bin": b, "shift": s} for b, s in m] for m in made.values()], "open": [b in left for b in fills],
        })

    while True:
        last = level.agg(F.max("task")).first()[0]
        if not last:
            break
        packed = stage(
            level.groupBy(F.floor(F.col("task") / FAN_IN).alias("group")).applyInPandas(
                pack, f"task int, fill long, {_MEMBER}, open boolean"
            ),
            "open-bins",
        )
        closed.append(packed.where("NOT open").select("members"))
        level = packed.where("open").drop("open")
    ends = level.select("members")
    for done in closed:
        ends = ends.union(done)
    return (
        ends.withColumn("target", F.col("members")[0]["bin"]).select("target", F.explode("members").alias("m"))
        .select(F.col("m.bin").alias("sequence_id"), "target", F.col("m.shift").alias("shift"))
    )


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    placed = stage(place_pieces(docs, tokenizer_path, end_id, capacity, open_bins, id_col, text_col), "pieces")
    bins = placed.where("piece = -1").select("task", F.col("sequence_id").alias("bin"), F.col("open_fill").alias("fill"))
    moves = merge_open(bins, capacity, open_bins)
    return placed.where("piece >= 0").join(moves, "sequence_id", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("target", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
