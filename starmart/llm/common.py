"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import stage

SPACE = r"[\x20\x09-\x0D]+"  # the white space of the contracts; bytes.split() cuts at the same bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have (case apart)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under fixed names: other columns can't clash with those made later."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the undirected ``edges(a, b)``; component = its smallest node.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so a chain of n nodes needs about log n rounds.  Labels
    are written to the shared folder in each round: the lineage stays short, and
    both join sides are plain scans whose skewed partitions AQE can split.
    """
    both = stage(
        edges.where(F.col("a") != F.col("b")).select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
        )).alias("e")).select("e.*").distinct(),
        label,
    )
    labels = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")), label)
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), F.col("l").alias("m")), "v")
        lower = near.groupBy("u").agg(F.min("m").alias("m"))
        pulled = stage(
            labels.join(lower, "u").select("u", F.least("l", "m").alias("l"), (F.col("m") < F.col("l")).alias("moved")),
            label,
        )
        if pulled.where("moved").isEmpty():
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
        hop = pulled.select(F.col("u").alias("l"), F.col("l").alias("further"))
        labels = stage(
            pulled.join(hop, "l", "left").select("u", F.coalesce("further", "l").alias("l")), label
        )


FILTER_BITS = 1 << 27  # of the filter below: at most 2 M words of 16 bytes on each executor


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(maybe, others): the rows whose ``key`` may be in the one column of ``keys``, and those whose isn't.

    A Bloom filter of at most ``FILTER_BITS`` bits is broadcast, so the others need no
    shuffle; a fuller filter only lets more rows pass for maybe.  ``rows`` has no column
    that begins with an underscore but those of the caller's own making.
    """
    words = min(16 * keys.count(), FILTER_BITS) // 64 + 1
    name = keys.columns[0]

    def positions(c: str) -> list[Column]:
        return [F.pmod(F.xxhash64(c, F.lit(k)), F.lit(words * 64)) for k in range(2)]

    at = keys.select(F.explode(F.array(*positions(name))).alias("pos"))
    one = F.expr("shiftleft(1L, cast(pos & 63 as int))")
    bits = stage(at.groupBy(F.shiftright("pos", 6).alias("word")).agg(F.bit_or(one).alias("bits")), "key-filter")
    maybe = F.lit(True)
    for k, position in enumerate(positions(key)):
        side = F.broadcast(bits.select(F.col("word").alias(f"_word{k}"), F.col("bits").alias(f"_bits{k}")))
        rows = rows.withColumn(f"_pos{k}", position).withColumn(f"_word{k}", F.shiftright(f"_pos{k}", 6))
        rows = rows.join(side, f"_word{k}", "left")
        hit = F.expr(f"shiftright(_bits{k}, cast(_pos{k} & 63 as int)) & 1L") == 1
        maybe = maybe & F.coalesce(hit, F.lit(False))
    probed = rows.withColumn("_maybe", maybe).drop(*[f"_{n}{k}" for k in range(2) for n in ("pos", "word", "bits")])
    return probed.where("_maybe").drop("_maybe"), probed.where("NOT _maybe").drop("_maybe")


def give_back() -> None:
    """Hand memory that a task has freed back to the system: Python workers live on, and their sums count."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some systems have it
    if trim:
        trim(0)


def each_batch(make, at_end=None, rows: int | None = None):
    """Function for mapInArrow that turns every record batch, or so many ``rows`` of it, into one table.

    ``at_end`` is called when a task is done.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for k in range(0, batch.num_rows, rows or batch.num_rows or 1):
                    yield make(batch.slice(k, rows))
        finally:
            if at_end:
                at_end()
                give_back()

    return run


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def id_column(df: DataFrame, name: str) -> Column:
    return df[name].cast("long")


class Remembered(dict):
    """A dictionary that makes a missing value from its key."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value
