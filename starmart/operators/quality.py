"""Data-quality checks as one-pass aggregates, in the check-result model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED, FAILED, WARNING = "passed", "failed", "warning"


@dataclass(frozen=True)
class Check:
    """``violation`` marks a bad row; a failing ``soft`` check is a warning."""

    check_type: str
    check_name: str
    violation: Column
    soft: bool = False


def not_null(column: str) -> Check:
    return Check("not_null", f"{column} not null", F.col(column).isNull())


def in_range(column: str, low, high, soft: bool = False) -> Check:
    return Check("range", f"{column} in [{low}, {high}]", ~F.col(column).between(low, high), soft)


def max_length(column: str, length: int) -> Check:
    return Check("length", f"{column} length <= {length}", F.length(column) > length)


def in_domain(column: str, values: list[str], soft: bool = False) -> Check:
    return Check("domain", f"{column} in domain", ~F.col(column).isin(values), soft)


def run_checks(df: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table in one scan, one result row per check.

    NULL neither violates a range nor a domain, as in a CHECK constraint.
    """
    counts = df.agg(*[F.count_if(c.violation).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.check_type).alias("check_type"),
                F.lit(c.check_name).alias("check_name"),
                F.col(f"c{i}").alias("violations"),
                F.lit(c.soft).alias("soft"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return _results(counts.select(F.inline(rows)), table_name)


def _results(violations: DataFrame, table_name: str) -> DataFrame:
    bad = F.col("violations") > 0
    return violations.select(
        F.lit(table_name).alias("table_name"),
        "check_type",
        "check_name",
        F.lit("0").alias("expected_value"),
        F.col("violations").cast("string").alias("actual_value"),
        F.when(~bad, PASSED).when(F.col("soft"), WARNING).otherwise(FAILED).alias("check_result"),
    )


def stamp_results(results: DataFrame, load_id: int, at: dt.datetime) -> DataFrame:
    """Check results as stored: with the load they belong to and the time of the check."""
    return results.withColumns(
        {"load_id": F.lit(load_id).cast("bigint"), "check_timestamp": F.lit(at).cast("timestamp_ntz")}
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def unique_check(df: DataFrame, table_name: str, keys: list[str]) -> DataFrame:
    name = F.lit(", ".join(keys) + " unique")
    found = duplicate_keys(df, keys).agg(
        F.lit("unique").alias("check_type"),
        name.alias("check_name"),
        F.count(F.lit(1)).alias("violations"),
        F.lit(False).alias("soft"),
    )
    return _results(found, table_name)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return child.where(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("_parent"), "left_anti"
    )


def foreign_key_check(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, table_name: str
) -> DataFrame:
    """Orphan count.  Child keys are counted before the join, so a hot key crosses as one row."""
    keys = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("_n"))
    found = orphans(keys, parent, child_key, parent_key).agg(
        F.lit("foreign_key").alias("check_type"),
        F.lit(f"{child_key} references {parent_key}").alias("check_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"),
        F.lit(False).alias("soft"),
    )
    return _results(found, table_name)


def cascade_delete(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """ON DELETE CASCADE: only children of surviving parents remain (NULL references stay)."""
    parents = parent.select(F.col(parent_key).alias("_parent"), F.lit(True).alias("_alive"))
    joined = child.join(parents, F.col(child_key) == F.col("_parent"), "left")
    return joined.where(F.col("_alive") | F.col(child_key).isNull()).drop("_parent", "_alive")


def clear_reference(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """ON DELETE SET NULL."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    joined = child.join(parents, F.col(child_key) == F.col("_parent"), "left")
    return joined.withColumn(child_key, F.col("_parent")).drop("_parent")


def restrict_delete(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> None:
    """ON DELETE RESTRICT: fail the load when an orphan exists."""
    if not orphans(child, parent, child_key, parent_key).isEmpty():
        raise ValueError(f"{child_key} refers to rows missing from {parent_key}")
