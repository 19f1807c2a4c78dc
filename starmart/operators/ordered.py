"""Ordered computations in which no key, however hot, has to fit into one task.

An ordinary window puts a whole group into one task.  The functions here split the
rows into *blocks* instead, whatever their number: ``repartitionByRange`` on (key,
order) cuts even a single hot key over many partitions, and the row position is stored
with the rows in the shared folder so it can never be drawn differently by a re-run.
Each block is a bucket of its own there, so work inside blocks reads it in place: the
range split is the only exchange of all rows.  What crosses block borders (a
running total, a previous row, a count) is one small row per block, so broadcasting
it is bounded by the number of partitions and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import stage_in_buckets

_POSITION, _BLOCK, _BUCKET = "_position", "_block", "_bucket"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above, row number below


def _blocks(df: DataFrame, order: list[Column]) -> DataFrame:
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ordered.withColumn(_POSITION, F.monotonically_increasing_id())
    return stage_in_buckets(placed.withColumn(_BLOCK, F.shiftright(_POSITION, _LOCAL_BITS)), _BLOCK, _BUCKET, "blocks")


def _block_offsets(blocks: DataFrame) -> DataFrame:
    """One row per block: rows before it, and rows in all.  At most one row per partition."""
    sizes = blocks.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias("_size"))
    all_blocks = Window.partitionBy(F.lit(0))
    before = all_blocks.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        _BLOCK,
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(all_blocks).alias("_total"),
    )


def _join_keys(rows: DataFrame, side: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join in which a NULL key meets itself, as it does inside a window."""
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys]
    return rows.join(renamed, same, how).drop(*[f"_side_{k}" for k in keys])


def number_rows(
    df: DataFrame, order: list[Column], name: str, total: str | None = None, start: int = 1
) -> DataFrame:
    """Dense global row number in ``order`` (which must be unique) without a global window."""
    blocks = _blocks(df, order)
    local = F.col(_POSITION).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    numbered = blocks.join(F.broadcast(_block_offsets(blocks)), _BLOCK)
    out = numbered.withColumn(name, F.col("_before") + local + F.lit(start))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop(_BLOCK, _BUCKET, _POSITION, "_before", "_total")


def ntile(row_number: Column, total: Column, buckets: int) -> Column:
    """Bucket of a row number; the first ``total mod buckets`` buckets hold one row more."""
    size = F.floor(total / buckets)
    wide = total % buckets
    in_wide = wide * (size + 1)
    # Below ``buckets`` rows every bucket is a wide one, so the narrow size is never divided by.
    narrow = wide + F.ceil((row_number - in_wide) / F.greatest(size, F.lit(1)))
    return F.when(row_number <= in_wide, F.ceil(row_number / (size + 1))).otherwise(narrow).cast("int")


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Row number per key in ``order``."""
    numbered = number_rows(df, [*map(F.col, keys), *order], "_rn")
    first = numbered.groupBy(*keys).agg(F.min("_rn").alias("_first"))
    ranked = _join_keys(numbered, first, keys, "inner")
    return ranked.withColumn(name, (F.col("_rn") - F.col("_first") + 1).cast("int")).drop("_rn", "_first")


def running_sums(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, Column]) -> DataFrame:
    """Per new column the sum of its value from the first row of the key up to this one.

    The sums have the type that one window over the key would give them.
    """
    addends = {f"_add_{name}": value for name, value in values.items()}
    blocks = _blocks(df.withColumns(addends), [*map(F.col, keys), *order])
    inside = Window.partitionBy(_BUCKET, *keys).orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        blocks.groupBy(_BUCKET, *keys)
        .agg(F.min(_BLOCK).alias(_BLOCK), *[F.sum(c).alias(c) for c in addends])
        .select(
            _BUCKET,
            *keys,
            F.lag(_BLOCK).over(Window.partitionBy(*keys).orderBy(_BLOCK)).alias("_before"),
            *[F.sum(c).over(earlier).alias(f"_carry{c}") for c in addends],
        )
        # Only a key that began in an earlier block has a carry: at most one per block.
        .where(F.col("_before").isNotNull())
        .drop("_before")
    )
    summed = blocks.withColumns({f"_inside{c}": F.sum(c).over(inside) for c in addends})
    out = _join_keys(summed, F.broadcast(carry), [_BUCKET, *keys], "left")

    def total(c: str) -> Column:
        inner, before = F.col(f"_inside{c}"), F.col(f"_carry{c}")
        return F.coalesce(inner + before, inner, before).cast(summed.schema[f"_inside{c}"].dataType)

    return out.select(*df.columns, *[total(f"_add_{name}").alias(name) for name in values])


def previous_row(df: DataFrame, keys: list[str], order: list[Column], columns: dict[str, str]) -> DataFrame:
    """Values of the preceding row of the same key: ``columns`` maps new name to source column."""
    carried = F.struct(*[F.col(old).alias(new) for new, old in columns.items()])
    blocks = _blocks(df.withColumn("_row", carried), [*map(F.col, keys), *order])
    inside = Window.partitionBy(_BUCKET, *keys).orderBy(_POSITION)
    carry = (
        blocks.groupBy(_BUCKET, *keys)
        .agg(F.min(_BLOCK).alias(_BLOCK), F.max_by("_row", _POSITION).alias("_last"))
        .select(_BUCKET, *keys, F.lag("_last").over(Window.partitionBy(*keys).orderBy(_BLOCK)).alias("_carry"))
        .where(F.col("_carry").isNotNull())  # at most one key per block, as above
    )
    out = _join_keys(
        blocks.withColumn("_prev", F.lag("_row").over(inside)), F.broadcast(carry), [_BUCKET, *keys], "left"
    )
    # A block's first row of a key has no row before it inside; only that row takes the carry.
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    return out.select(*df.columns, *[prev[new].alias(new) for new in columns])
