"""Upserts and merge-time collapse, as joins and aggregates over immutable tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], version: list[Column]) -> DataFrame:
    """The row with the greatest version per key; equal versions fall to the greatest row,
    so a re-run picks the same.

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(F.struct(*version).alias("_version"), *rest)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


def summing_merge(df: DataFrame, keys: list[str], additive: list[str], total_type: str | None = None) -> DataFrame:
    """Rows of equal key collapse; only additive columns are summed, so ratios
    and flags must be derived again from the sums."""
    sums = [F.sum(c) if total_type is None else F.sum(c).cast(total_type) for c in additive]
    return df.groupBy(*keys).agg(*[s.alias(c) for s, c in zip(sums, additive)])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str],
    touch: tuple[str, dt.datetime] | None = None,
    each_row: bool = False,
) -> DataFrame:
    """Matched rows take ``update_columns`` from the source (NULL included), the rest stays;
    unmatched source rows are inserted.  ``touch`` stamps updated rows.

    A key that ``source`` repeats is an error; see :func:`latest_per_key`.  With ``each_row``
    every source row gives a row of its own, as a join of the two tables does.
    """
    t = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("t"))
    row = F.struct(*[c for c in source.columns if c not in keys])
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("upsert: the source repeats a key"))).otherwise(F.any_value(row))
    s = source.select(*keys, row.alias("s")) if each_row else source.groupBy(*keys).agg(once.alias("s"))
    joined = t.join(s, keys, "full_outer")
    source_columns = set(source.columns)
    matched, inserted = F.col("t").isNotNull() & F.col("s").isNotNull(), F.col("t").isNull()
    out = []
    for field in target.schema.fields:
        c = field.name
        if c in keys:
            out.append(F.col(c))
            continue
        new = F.col("s")[c] if c in source_columns else F.lit(None)
        new, old = new.cast(field.dataType), F.col("t")[c]
        if touch and c == touch[0]:
            value = F.when(matched, F.lit(touch[1]).cast(field.dataType)).when(inserted, new).otherwise(old)
        elif c in update_columns:
            value = F.when(F.col("s").isNotNull(), new).otherwise(old)
        else:
            value = F.when(inserted, new).otherwise(old)
        out.append(value.alias(c))
    return joined.select(*out)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks, one row per key.

    Among several source rows of one key the smallest row wins, so a re-run
    inserts the same.
    """
    rest = [c for c in source.columns if c not in keys]
    once = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    once = once.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    return target.unionByName(once.join(target.select(*keys), keys, "left_anti").select(*source.columns))
