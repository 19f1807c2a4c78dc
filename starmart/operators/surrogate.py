"""Surrogate keys: dense generation, continuation, lookup, unresolved members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.ordered import number_rows
from starmart.session import stage

UNKNOWN_KEY = -1


def assign_keys(df: DataFrame, key: str, business_key: list[str]) -> DataFrame:
    """Dense 1..n in business-key order."""
    return number_rows(df, [F.col(c) for c in business_key], key)


def largest_key(df: DataFrame, key: str) -> int:
    return df.agg(F.max(key).alias("k")).first()["k"] or 0


def append_keys(existing: DataFrame, new: DataFrame, key: str, business_key: list[str]) -> DataFrame:
    """Keys for ``new`` that continue after the greatest key of ``existing``."""
    start = largest_key(existing, key) + 1
    return number_rows(new, [F.col(c) for c in business_key], key, start=start)


def fill_missing_keys(df: DataFrame, key: str, business_key: list[str]) -> DataFrame:
    """Keep given keys; number the rows without one after the greatest given key."""
    staged = stage(df, "unkeyed")
    keyed = staged.where(F.col(key).isNotNull())
    fresh = staged.where(F.col(key).isNull()).drop(key)
    return keyed.unionByName(append_keys(keyed, fresh, key, business_key))


def lookup(
    fact: DataFrame, dim: DataFrame, fact_column: str, dim_column: str, key: str, as_name: str | None = None
) -> DataFrame:
    """Left outer business-to-surrogate lookup; both join columns are renamed apart.

    No broadcast hint: Spark broadcasts the two-column side when its size allows,
    and otherwise joins by shuffle with adaptive skew splitting.
    """
    name = as_name or key
    side = dim.select(F.col(dim_column).alias("_lookup_id"), F.col(key).alias(name))
    return fact.join(side, F.col(fact_column) == F.col("_lookup_id"), "left").drop("_lookup_id")


def unknown_member(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_KEY))


def split_unresolved(fact: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(loadable, quarantined with the list of unresolved keys)."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull()
    )
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return fact.where(~bad), fact.where(bad).withColumn("unresolved", F.array_join(missing, ","))
