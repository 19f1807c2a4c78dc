"""Benchmark decontamination with SimHash windows; DataFrame functions only.

Every document is read as word shingles (five words; an item of fewer words is one shingle
of its own width).  Where a shingle of some item appears, the item-sized window in which it
would sit at the item's own place is fingerprinted.  A multi-index over blocks of the
fingerprint (one block more than the radius has bits, so two fingerprints within the radius
agree on some block) brings each window to the items of its size within the radius, and the
exact weighted similarity of the shingles, sum of the lesser over sum of the greater counts,
decides.  A window that is 0.8 similar to an item holds most of its shingles, so no such
window is missed by starting from shared shingles; two texts that similar lie within about
14 bits and never were found beyond 18, so the radius is 20.

The benchmark is the stated query set: it is worked off in blocks of at most
``MAX_QUERY_SHINGLES`` shingles, which bounds what a plan carries and what is broadcast.

Words are runs of letters and digits, lower-cased, so punctuation glued to a passage doesn't
hide it.  Defined results: null and wordless texts and items match nothing.  Repeated
documents give their rows each; items with equal texts are each reported.  Empty tables give
no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import free_name, only
from starmart.session import stage

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
MAX_QUERY_SHINGLES = 50_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(text: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order; none if the text has fewer words."""

    def hashes(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - width)
        runs = F.transform(starts, lambda i: F.xxhash64(*[words[i + k] for k in range(width)]))
        return F.when(F.size(words) >= width, runs).otherwise(F.array().cast("array<bigint>"))

    return _let(_words(text), hashes)


def fingerprint(hashes: Column) -> Column:
    """SimHash of the shingles, each weighing as often as it appears: a bit is 1 if more than half have it."""

    def bits(own: Column) -> Column:
        def bit(acc: Column, b: Column) -> Column:
            ones = F.aggregate(own, F.lit(0), lambda n, h: n + F.call_function("getbit", h, b).cast("int"))
            return F.call_function("shiftleft", acc, F.lit(1)).bitwiseOR((ones * 2 > F.size(own)).cast("long"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)

    return _let(hashes, bits)


def blocks(fp: Column, radius: int) -> Column:
    """(number, value) of radius + 1 blocks; fingerprints within the radius agree on at least one."""
    cuts = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    cut = [
        F.struct(F.lit(n).alias("n"), F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for n, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
    ]
    return F.array(*cut)


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles, repeats counted."""

    def common(acc: Column, h: Column) -> Column:
        def times(side: Column) -> Column:
            return F.size(F.filter(side, lambda x: x == h))

        return acc + F.least(times(a), times(b))

    lesser = F.aggregate(F.array_distinct(a), F.lit(0), common)
    return lesser / (F.size(a) + F.size(b) - lesser)


def _item_blocks(items: DataFrame) -> list[list[tuple[int, int]]]:
    """The (item number, size in words) of each block of the query set, so that a block's shingles stay few."""
    sizes = [(r["item"], r["size"]) for r in items.select("item", "size").orderBy("size", "item").collect()]
    out: list[list[tuple[int, int]]] = []
    room = 0
    for item, size in sizes:
        width = min(SHINGLE, size)
        if not out or room < size or min(SHINGLE, out[-1][0][1]) != width:
            out.append([])
            room = MAX_QUERY_SHINGLES
        out[-1].append((item, size))
        room -= size
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", radius: int = RADIUS, least: float = SIMILARITY,
) -> DataFrame:
    """doc_id, item_id, similarity, first_word, text_hash: the best window of each document for each item it holds."""
    source = only(docs, doc_id=id_col, text=text_col)
    named = only(benchmark, item_id=item_col, text=item_text_col)
    items = stage(
        named.select(F.monotonically_increasing_id().alias("item"), "item_id", "text", F.size(_words(F.col("text"))).alias("size"))
        .where("size > 0"),
        "items",
    )
    parts = [_block_matches(source, items, block, radius, least) for block in _item_blocks(items)]
    nothing = source.crossJoin(named.select("item_id").limit(0)).where(F.lit(False)).select(
        "doc_id", "item_id", F.lit(0.0).alias("similarity"), F.lit(0).alias("first_word"), F.xxhash64("text").alias("text_hash")
    )
    return reduce(DataFrame.unionByName, parts) if parts else nothing


def _block_matches(source: DataFrame, items: DataFrame, block: list[tuple[int, int]], radius: int, least: float) -> DataFrame:
    width = min(SHINGLE, block[0][1])
    own = items.where(F.col("item").isin([i for i, _ in block])).withColumn("item_hashes", shingles(F.col("text"), width))
    own = stage(own.select("item", "item_id", "size", "item_hashes", fingerprint(F.col("item_hashes")).alias("item_fp")), "query-items")
    asked = [r["h"] for r in own.select(F.explode("item_hashes").alias("h")).distinct().collect()]
    hit = F.exists(shingles(F.col("text"), width), lambda h: h.isin(asked))
    # Only documents that hold a shingle of the block go on, as shingle hashes.
    held = stage(
        source.where(hit).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
            shingles(F.col("text"), width).alias("hashes"),
        ),
        "held",
    )
    places = F.broadcast(own.select("size", F.posexplode("item_hashes").alias("offset", "h")).distinct())
    spots = held.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h")).join(places, "h")
    last = F.col("n") - (F.col("size") - width + 1)
    starts = spots.select("row", "size", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), last)).alias("first")).distinct()
    windows = starts.join(held, "row").select(
        "row", "doc_id", "text_hash", "size", "first",
        F.slice("hashes", F.col("first") + 1, F.col("size") - width + 1).alias("hashes"),
    )
    printed = stage(windows.withColumn("fp", fingerprint(F.col("hashes"))), "windows")
    index = F.broadcast(own.select("item", "size", "item_fp", F.explode(blocks(F.col("item_fp"), radius)).alias("block")))
    near = (
        printed.select("row", "first", "size", "fp", F.explode(blocks(F.col("fp"), radius)).alias("block"))
        .join(index, ["size", "block"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select("row", "first", "size", "item").distinct()
    )
    checked = (
        near.join(printed, ["row", "first", "size"])
        .join(F.broadcast(own.select("item", "item_id", "item_hashes")), "item")
        .withColumn("similarity", similarity(F.col("hashes"), F.col("item_hashes")))
        .where(F.col("similarity") >= least)
    )
    best = F.max(F.struct("similarity", (-F.col("first")).alias("back"))).alias("best")
    return checked.groupBy("row", "doc_id", "text_hash", "item", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("first_word"), "text_hash"
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col)
    row_id, text_hash = free_name(docs, "_found_id"), free_name(docs, "_found_hash")
    found = stage(found.select(F.col("doc_id").alias(row_id), F.col("text_hash").alias(text_hash)).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(found[row_id]) & (F.xxhash64(docs[text_col]) == found[text_hash])
    return docs.join(found, same, "left_anti")
