"""SimHash near-duplicates found with pigeonring filtering.

A fingerprint's 64 bits form a ring of ``SEGMENTS`` segments.  Two fingerprints within
``RADIUS`` bits have, from some segment on, every chain of l consecutive segments differing
in at most l * RADIUS / SEGMENTS bits.  With 7 segments and radius 2 the first three
segments of that chain are equal, so those 27 to 28 bits are the join key of each of the
seven starts; the longer chains prune the pairs that meet before the whole distance is
looked at.  No pair within the radius is lost.

Equal fingerprints are one class before any pair is made.  A key shared by more than
``MAX_BUCKET`` classes makes no pairs: its fingerprints are linked through their
one-bit neighbours instead (two fingerprints are within two bits exactly if they share a
neighbour or one is the other's), which gives the same components in linear size.

Defined results: null and wordless texts have fingerprint zero and are linked like any
other.  Repeated rows give a row each.  A null id is never the smallest of its component
unless all ids there are null.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import connected_components, each_batch, give_back, only, split_by_keys, texts
from starmart.session import stage

RADIUS = 2
SEGMENTS = 7
MAX_BUCKET = 256
SHINGLE = 3
HASH_BLOCK = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[: len(words) - width]]]
    hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends[width - 1 :])]
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), HASH_BLOCK):
        block = np.array(hashes[lo : lo + HASH_BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every document; fp is the fingerprint as a signed long."""
    source = only(docs, doc_id=id_col, text=text_col)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in texts(batch)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(each_batch(make), f"doc_id {kind}, fp long")


def _ring(segments: int, radius: int) -> tuple[list[int], list[list[int]], int]:
    """Key mask of every start, masks of its chains of 1.. segments, and the number of equal segments in the key."""
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(segments)]
    chains = []
    for start in range(segments):
        mask, own = 0, []
        for length in range(segments):
            mask |= parts[(start + length) % segments]
            own.append(mask)
        chains.append(own)
    equal = next(n for n in range(segments) if (n + 1) * radius // segments > 0)
    return [own[equal - 1] for own in chains], chains, equal


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def candidate_keys(fps: DataFrame, segments: int, radius: int) -> DataFrame:
    """(start, key, fp) for every start of the ring."""
    masks, _, equal = _ring(segments, radius)
    if not equal:
        raise ValueError("more segments than the radius are needed")
    keys = [F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.*", "fp")


def _within_budgets(a: Column, b: Column, segments: int, radius: int) -> Column:
    """Every chain from the start on stays within its share of the radius; the last is the whole ring."""
    _, chains, equal = _ring(segments, radius)
    differ, ok = a.bitwiseXOR(b), F.lit(True)
    for length in range(equal + 1, segments + 1):
        masks = F.array(*[F.lit(_signed(own[length - 1])) for own in chains])
        chain = differ.bitwiseAND(F.element_at(masks, F.col("start") + 1))
        ok = ok & (F.bit_count(chain) <= length * radius // segments)
    return ok & (F.bit_count(differ) <= radius)


def links(
    fps: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, max_bucket: int = MAX_BUCKET
) -> DataFrame:
    """(a, b) pairs of distinct fingerprints that connect exactly what pairs within the radius connect.

    ``fps`` has the distinct fingerprints in ``fp``.  Keys of at most ``max_bucket``
    fingerprints give all their pairs within the radius.
    """
    if radius != 2:
        raise ValueError("crowded keys are resolved for a radius of two bits")
    keyed = candidate_keys(fps, segments, radius)
    shared = stage(keyed.groupBy("start", "key").count().where(F.col("count") > 1), "keys")
    few, crowded = shared.where(F.col("count") <= max_bucket), shared.where(F.col("count") > max_bucket)
    meeting = keyed.join(few.drop("count"), ["start", "key"])
    a, b = meeting.withColumnRenamed("fp", "a"), meeting.withColumnRenamed("fp", "b")
    pairs = (
        a.join(b, ["start", "key"])
        .where((F.col("a") < F.col("b")) & _within_budgets(F.col("a"), F.col("b"), segments, radius))
        .select("a", "b")
    )
    dense = keyed.join(crowded.drop("count"), ["start", "key"], "left_semi").select("fp").distinct()
    near = [F.lit(0).cast("long"), *[F.lit(_signed(1 << bit)) for bit in range(64)]]
    ball = dense.select("fp", F.explode(F.array(*near)).alias("flip"))
    ball = ball.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
    centre = ball.groupBy("near").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    through = ball.join(centre, "near").where(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(through).distinct()


def cluster(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest id reachable over links."""
    marks = stage(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    nodes = connected_components(links(classes.select("fp"), radius))
    joined = classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    lowest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(joined.join(lowest, "component").select("fp", "component_id"), "named")
    # Both sides are plain scans: AQE splits a fingerprint that many copies share.
    return marks.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- near copies by similarity -----------------------------------------------------------

COPY_SHINGLE, COPY_SIMILARITY = 5, 0.8
COPY_RADIUS = 18  # of the first links only; the pairs they leave apart are not pruned by bits
BANDS, ROWS = 8, 3  # of the first links: a pair 0.8 similar shares a key with probability 0.997
ORDER_SAMPLE = 8  # one document in so many is asked which shingles are common
COMMON = 1 << 16  # common shingles told to every task
PARITY_LONGS = 8  # of the parities that travel with a document's rare shingles
# Of a document's map of its shingles, at least and by size; two maps differ in no more bits than the sets in shingles.
MAP_BITS, MAP_BITS_PER_SHINGLE = 1024, 4


def _shingle_hashes(text: str, width: int) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()
    digest = xxhash.xxh64_intdigest
    runs = [b" ".join(words)] if 0 < len(words) < width else [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    return np.array([digest(r, 42) for r in runs], dtype=np.uint64)


def _common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of shingles that many documents of a sample hold.

    They only set the order in which a document's shingles are taken as keys.  Any one
    order gives the same links, so the sample and the ``COMMON`` bound cost no result.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(_shingle_hashes(t, width)) for t in texts(batch)]
        found, times = np.unique(np.concatenate(own), return_counts=True)
        often = times > 2
        return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(times[often])], names=["h", "n"])

    sample = docs.where(F.pmod("node", F.lit(ORDER_SAMPLE)) == 0).select("node", "text")
    found = sample.mapInArrow(each_batch(count, give_back), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.col("n").desc(), "h").limit(COMMON).collect()
    hashes, counts = (np.array([r[c] for r in top], np.int64) for c in ("h", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], counts[order]


def _rare_first(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct shingles in the order of (count in the sample, hash), the same order for every document."""
    known, counts = common
    times = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        times = np.where(known[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, times))]


def _map_bits(size: int) -> int:
    """A power of two with room for a set of this size: a fuller map would tell sets apart no longer."""
    return max(MAP_BITS, 1 << (MAP_BITS_PER_SHINGLE * size - 1).bit_length())


def _folded(bits: Column, longs: Column) -> Column:
    """A map as it would have been with ``longs`` words, a power of two below its own."""
    return F.when(F.size(bits) == longs, bits).otherwise(
        F.transform(F.sequence(F.lit(0), longs - 1), lambda i: F.aggregate(
            F.sequence(F.lit(0), (F.size(bits) / longs).cast("int") - 1), F.lit(0).cast("long"),
            lambda seen, k: seen.bitwiseOR(F.get(bits, (i + k * longs).cast("int"))),
        ))
    )


def _sketches(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(node, doc_id, fp, least, size, keys, parity, map) of the documents with words.

    SimHash of the distinct shingles; the least of them in each of BANDS * ROWS orders; their
    number; the rarest of them, so many that two similar documents have one in common; whether
    an odd number of them falls on each bit of a small map; and the map of bits they set.
    """
    orders = np.random.default_rng(42).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    common = _common_shingles(docs, width)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, fps, least, sizes, keys, parities, maps = [], [], [], [], [], [], []
        for n, text in enumerate(texts(batch)):
            hashes = np.unique(_shingle_hashes(text, width))
            if len(hashes):
                keep.append(n)
                counts = np.zeros(64, np.int64)
                low = np.full(len(orders), np.iinfo(np.uint64).max, np.uint64)
                for lo in range(0, len(hashes), HASH_BLOCK):
                    block = hashes[lo : lo + HASH_BLOCK]
                    counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
                    low = np.minimum(low, [(block * a).min() for a in orders])
                fps.append(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])
                least.append(low.view(np.int64))
                sizes.append(len(hashes))
                # Similar sets have similarity * size shingles in common, so one among the others and one more.
                rare = len(hashes) - math.ceil(similarity * len(hashes) - 1e-6) + 1
                keys.append(_rare_first(hashes, common)[:rare].view(np.int64))
                odd = np.bincount((hashes % np.uint64(64 * PARITY_LONGS)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                own = np.zeros(_map_bits(len(hashes)), np.uint8)
                own[(hashes % np.uint64(len(own))).astype(np.int64)] = 1
                maps.append(np.packbits(own).view(np.int64))
        at, longs = pa.array(keep, pa.int32()), pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(fps, pa.int64()), pa.array(least, longs),
             pa.array(sizes, pa.int32()), pa.array(keys, longs), pa.array(parities, longs), pa.array(maps, longs)],
            names=["node", "doc_id", "fp", "least", "size", "keys", "parity", "map"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("node", "doc_id", "text").mapInArrow(
        each_batch(make, give_back),
        f"node long, doc_id {kind}, fp long, least array<long>, size int, keys array<long>, parity array<long>, map array<long>",
    )


def _on_some_ring(a: Column, b: Column, segments: int, radius: int) -> Column:
    """Whether from some start every chain of segments stays within its share of the radius."""
    _, chains, _ = _ring(segments, 1)
    differ, some = a.bitwiseXOR(b), F.lit(False)
    for own in chains:
        every = F.lit(True)
        for length, mask in enumerate(own, 1):
            every = every & (F.bit_count(differ.bitwiseAND(F.lit(_signed(mask)))) <= length * radius // segments)
        some = some | every
    return some & (F.bit_count(differ) <= radius)


def _led_pairs(sketches: DataFrame, radius: int) -> DataFrame:
    """(a, b) pairs that are likely similar: in every key of least hashes each document meets three of its documents.

    The smallest id and two drawn by hash are met, and the pigeonring test prunes, so pairs
    are missed; ``_rest`` finds what the links of these leave apart.
    """
    keys = [F.xxhash64(F.lit(b), *[F.col("least")[b * ROWS + r] for r in range(ROWS)]) for b in range(BANDS)]
    rows = stage(
        sketches.select(F.struct("node", "fp").alias("own"), F.col("doc_id").isNull().alias("nil"), "doc_id", F.explode(F.array(*keys)).alias("key")),
        "bands",
    )
    leads = rows.groupBy("key").agg(
        F.min_by("own", F.struct("nil", "doc_id", "own.node")).alias("first"), F.min("own").alias("low"), F.max("own").alias("high")
    ).where(F.col("low") != F.col("high"))
    leads = stage(leads, "leads")
    met = rows.join(leads, "key").select("own", F.explode(F.array("first", "low", "high")).alias("other"))
    return (
        met.where((F.col("own.node") != F.col("other.node")) & _on_some_ring(F.col("own.fp"), F.col("other.fp"), SEGMENTS, radius))
        .select(F.least("own.node", "other.node").alias("a"), F.greatest("own.node", "other.node").alias("b")).distinct()
    )


def _meeting(rows: DataFrame, similarity: float) -> tuple[DataFrame, Column, Column]:
    """The pairs of ``rows(component, node, size, at, key, odd..)`` that meet in a key and may be similar enough.

    With them the number of shingles they need in common, and how many they can share from the
    key on.  A shingle that only one of two documents has changes one of their parities, so no
    more of these differ than shingles do: most pairs of a crowd of texts not similar enough end here.
    """
    odd = [c for c in rows.columns if c.startswith("odd")]
    a, b = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("component", "node", "size", "at", *odd)]) for side in "ab")
    needed = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("size_a") + F.col("size_b")) - 1e-6)
    after = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in odd])
    pairs = a.join(b, "key").where(
        (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
        & (F.least("at_a", "at_b") + after >= needed) & (differ <= F.col("size_a") + F.col("size_b") - 2 * needed)
    )
    return pairs, needed, after


def _rest(sketches: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """(a, b): every pair of documents in different ``groups`` that may be similar enough; none that is gets lost.

    Similar documents have one of their rarest shingles in common.  A shingle's place in the
    one order of all documents bounds what two documents can share before and after it, and
    their parities and maps bound what they don't share.
    """
    odd = [f"odd{k}" for k in range(PARITY_LONGS)]
    held = stage(
        sketches.select("node", "size", "keys", *[F.col("parity")[k].alias(c) for k, c in enumerate(odd)]).join(groups, "node", "left")
        .select("node", "size", "keys", *odd, F.coalesce("component", "node").alias("component")),
        "rare-shingles",
    )
    single = held.select("component", F.explode("keys").alias("key"))
    shared = single.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    shared = stage(shared.where("low != high").select("key"), "shared-shingles")
    maybe, _ = split_by_keys(held.select("component", "node", "size", *odd, F.posexplode("keys").alias("at", "key")), "key", shared)
    pairs, needed, after = _meeting(stage(maybe.join(shared, "key", "left_semi"), "meeting"), similarity)
    met = pairs.groupBy("node_a", "node_b", "size_a", "size_b").agg(
        F.count(F.lit(1)).alias("n"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b")
    )
    met = met.where(F.col("n") - 1 + after >= needed).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b"), (F.col("size_a") + F.col("size_b") - 2 * needed).alias("apart")
    )
    maps = sketches.groupBy("node").agg(F.first("map").alias("map"))  # rows equal in id and text have one node
    both = met.join(maps.select(F.col("node").alias("a"), F.col("map").alias("map_a")), "a")
    both = both.join(maps.select(F.col("node").alias("b"), F.col("map").alias("map_b")), "b")
    longs = F.least(F.size("map_a"), F.size("map_b"))
    both = both.withColumn("map_a", _folded(F.col("map_a"), longs)).withColumn("map_b", _folded(F.col("map_b"), F.size("map_a")))
    differ = F.aggregate(F.zip_with("map_a", "map_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return both.where(differ <= F.col("apart")).select("a", "b")


def _similar(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The ``pairs(a, b)`` whose sets of shingles are similar enough."""
    asked = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "asked")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(_shingle_hashes(t, width)).view(np.int64) for t in texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["node", "shingles"])

    maybe, _ = split_by_keys(docs.select("node", "text"), "node", asked)
    some = maybe.join(asked, "node", "left_semi")
    held = stage(some.mapInArrow(each_batch(sets, give_back), "node long, shingles array<long>"), "shingle-sets")
    of_a = pairs.join(held.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    of_both = of_a.join(held.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = common / (F.size("sa") + F.size("sb") - common)
    return of_both.where(alike >= similarity).select("a", "b")


def near_copies(
    docs: DataFrame, width: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY, radius: int = COPY_RADIUS
) -> DataFrame:
    """(a, b) links of ``docs(node, doc_id, text)`` that connect exactly what similar enough pairs connect.

    Most copies are linked to a few leads of their keys first, so a crowd of copies makes
    no pairs among its own.  Every pair that these links leave in different groups is then
    looked for by an exact bound on shared shingles.  The similarity of the sets of
    shingles decides in both steps.
    """
    sketches = stage(_sketches(docs, width, similarity), "sketches")
    led = stage(_similar(stage(_led_pairs(sketches, radius), "near-pairs"), docs, width, similarity), "led-links")
    groups = connected_components(led)
    rest = _similar(stage(_rest(sketches, groups, similarity), "rest-pairs"), docs, width, similarity)
    return led.unionByName(rest)


def _fingerprint_links(docs: DataFrame, radius: int) -> DataFrame:
    """(a, b) links of ``docs(node, text)`` that connect what ``cluster`` connects, wordless texts too."""
    marks = stage(fingerprints(docs, "node", "text"), "fingerprints")
    classes = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("lead")), "classes")
    own = marks.join(classes, "fp").where(F.col("doc_id") != F.col("lead")).select(F.col("doc_id").alias("a"), F.col("lead").alias("b"))
    of_a, of_b = (classes.select(F.col("fp").alias(c), F.col("lead").alias(f"lead_{c}")) for c in "ab")
    between = links(classes.select("fp"), radius).join(of_a, "a").join(of_b, "b")
    return own.unionByName(between.select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b")))


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = COPY_SHINGLE, similarity: float = COPY_SIMILARITY,
    radius: int | None = None,
) -> DataFrame:
    """The documents, of each group of near copies the one with the smallest id (null ids last).

    With a ``radius`` texts whose fingerprints ``cluster`` links are near copies too, wordless ones
    among them; else those have no shingles and stay.  Of rows equal in id and text one counts, the
    one whose columns hash lowest.
    """
    node = F.xxhash64(docs[id_col], docs[text_col])
    source = docs.select(node.alias("node"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    linked = near_copies(source, width, similarity)
    if radius is not None:
        linked = linked.unionByName(_fingerprint_links(source, radius))
    groups = connected_components(linked)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))
    members = source.select("node", "doc_id").join(groups, "node")
    stays = members.groupBy("component").agg(F.min_by("node", order).alias("node")).select("node")
    dropped = groups.join(stays, "node", "left_anti").select("node", F.lit(True).alias("gone")).distinct()
    again = source.groupBy("node").count().where(F.col("count") > 1).select("node", F.lit(False).alias("gone"))
    asked = stage(dropped.unionByName(again.join(dropped, "node", "left_anti")), "near-copies")
    # Only rows that may be dropped are shuffled; their columns travel as one.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), node.alias("node"))
    maybe, others = split_by_keys(rows, "node", asked.select("node"))
    kept = maybe.join(asked, "node", "left_anti").select("whole")
    equal = maybe.join(asked.where("NOT gone"), "node", "left_semi").groupBy("node", *[F.col("whole").getField(c) for c in (id_col, text_col)])
    first = equal.agg(F.min_by("whole", F.xxhash64("whole")).alias("whole")).select("whole")
    return others.select("whole").unionByName(kept).unionByName(first).select("whole.*")
