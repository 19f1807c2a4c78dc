"""Exact dedup with two passes over a Bloom filter; DataFrame functions only.

Pass one counts how many rows set each bit of a Bloom filter over the text digests and
keeps the bits set at least twice.  Pass two probes the rows: a row with a bit that only it
has set is certainly unique and goes straight through; the others, true repeats and few
false ones, are shuffled by digest and settled exactly.

The filter is broadcast, so its size is bounded: at most ``max_filter_bits`` bits, i.e.
``max_filter_bits / 64`` words.  A corpus that needs more bits is dealt, by digest, into
segments that have a filter each.

Defined results: a null text counts as empty, and empty texts equal each other.  A null id
is larger than any id.  Of rows that repeat an id and its text, exactly one stays (the one
whose columns hash lowest); of a group, one row in all.  An empty table gives no rows.
Columns of any name and type pass through ``keep_first``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, free_name, only
from starmart.session import new_path, stage

BITS_PER_ROW = 16  # two bits a row: about one row in seventy shuffles needlessly
MAX_FILTER_BITS = 1 << 27  # at most 2 M words of 16 bytes on each executor


def digest(text: Column) -> Column:
    """SHA-256 of the text in which each run of white space is one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256)


def _segments(keyed: DataFrame, rows: int, max_bits: int) -> list[tuple[DataFrame, int]]:
    """The rows, dealt so that each part's filter fits, and the number of filter words of a part."""
    bits = max(64, rows * BITS_PER_ROW)
    parts = math.ceil(bits / max_bits)
    words = max(1, math.ceil(bits / parts / 64))
    if parts == 1:
        return [(keyed, words)]
    # Written once, a folder for each segment: every row is read again with its own segment only.
    path = new_path(keyed.sparkSession, "segments")
    part = F.pmod(F.xxhash64("_digest", F.lit("segment")), F.lit(parts)).alias("_segment")
    keyed.select("*", part).write.partitionBy("_segment").parquet(path)
    dealt = keyed.sparkSession.read.parquet(path)
    return [(dealt.where(F.col("_segment") == s).drop("_segment"), words) for s in range(parts)]


def _positions(words: int) -> list[Column]:
    return [F.pmod(F.xxhash64("_digest", F.lit(k)), F.lit(words * 64)) for k in range(2)]


def repeated_bits(keyed: DataFrame, words: int) -> DataFrame:
    """Pass one: (word, bits) with the bits of the filter that at least two rows set."""
    set_by = keyed.select(F.explode(F.array_distinct(F.array(*_positions(words)))).alias("pos"))
    twice = set_by.groupBy("pos").count().where(F.col("count") > 1)
    word, bit = F.shiftright("pos", 6), F.expr("shiftleft(1L, cast(pos & 63 as int))")
    return twice.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def probe(keyed: DataFrame, words: int) -> DataFrame:
    """Pass two: the rows with ``_maybe``, whether all their bits were set by another row too."""
    seen = F.broadcast(stage(repeated_bits(keyed, words), "bloom"))
    maybe = F.lit(True)
    for k, position in enumerate(_positions(words)):
        side = seen.select(F.col("_word").alias(f"_word{k}"), F.col("_bits").alias(f"_bits{k}"))
        keyed = keyed.withColumn(f"_pos{k}", position).withColumn(f"_word{k}", F.shiftright(f"_pos{k}", 6))
        keyed = keyed.join(side, f"_word{k}", "left")
        hit = F.expr(f"shiftright(_bits{k}, cast(_pos{k} & 63 as int)) & 1L") == 1
        maybe = maybe & F.coalesce(hit, F.lit(False))
    return keyed.withColumn("_maybe", maybe).drop(*[f"_{n}{k}" for k in range(2) for n in ("pos", "word", "bits")])


def mark_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = MAX_FILTER_BITS,
    key: Callable[[Column], Column] = digest,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    source = only(docs, doc_id=id_col, text=text_col)
    keyed = stage(source.select("doc_id", key(F.col("text")).alias("_digest")), "digests")
    out = None
    for rows, words in _segments(keyed, keyed.count(), max_filter_bits):
        probed = probe(rows, words)
        alone = probed.where(~F.col("_maybe")).select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), "_digest",
        )
        marked = alone.unionByName(_settle(probed.where("_maybe")))
        out = marked if out is None else out.unionByName(marked)
    return out.withColumnRenamed("_digest", "text_sha256")


def _settle(candidates: DataFrame) -> DataFrame:
    """Exact groups among the candidates; counts before the shuffle keep a hot digest small."""
    copies = candidates.groupBy("_digest", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    # Written, so that both join sides are plain scans and AQE can split a hot digest.
    copies = stage(copies, "copies")
    groups = stage(
        copies.groupBy("_digest").agg(F.min("doc_id").alias("keep_id"), F.sum("_copies").alias("group_size")), "groups"
    )
    rows = copies.join(groups, "_digest").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_nth"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "_digest")


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = MAX_FILTER_BITS,
    key: Callable[[Column], Column] = digest,
) -> DataFrame:
    """The documents with all their columns, one for each text; only possible repeats are shuffled."""
    row = free_name(docs, "_row")
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias(row), key(docs[text_col]).alias("_digest"),
        docs[id_col].alias("_id"),
    )
    out = None
    for rows, words in _segments(keyed, docs.count(), max_filter_bits):
        probed = probe(rows, words)
        order = F.struct(F.col("_id").isNull(), F.col("_id"), F.xxhash64(row))
        first = probed.where("_maybe").groupBy("_digest").agg(F.min_by(row, order).alias(row))
        part = probed.where(~F.col("_maybe")).select(row).unionByName(first.select(row))
        out = part if out is None else out.unionByName(part)
    return out.select(f"{row}.*")
