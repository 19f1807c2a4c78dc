"""Plan shape: what must stay true of the physical plans at any scale."""

import pytest

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"

# Queries with a single-partition exchange over a bounded handful of rows.
FEW_ROWS = {
    # Global aggregates: one partial row per task.
    "calendar_check", "dim_date", "dim_date_holidays", "dq_domain", "dq_foreign_key", "dq_range", "dq_report",
    "incremental_extract", "retention_cleanup", "scd2_invariants", "staging_statistics", "system_kpis", "table_counts",
    # One row per transport type.
    "transport_type_share",
    # One row per range block (row counts before each block).
    "build_all_marts", "surrogate_key", "surrogate_key_append", "rfm_scores", "scd2_initial", "route_performance",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {}


def plan(spark, plans, name):
    if name not in plans:
        plans[name] = plan_of(queries()[name](spark, SF_DIR))
    return plans[name]


LAZY = [n for n in queries() if not n.startswith(("op", "pipeline", "stream_", "mart_incremental", "position_fact", "scd1", "scd2_a", "scd2_i"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_product_and_no_whole_table_in_one_task(spark, plans, name):
    text = plan(spark, plans, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    if name not in FEW_ROWS:
        lines = text.splitlines()
        below = [lines[n + 1] for n, line in enumerate(lines) if "Exchange SinglePartition" in line]
        # A global aggregate, as for the span of a calendar, gets one row from each task.
        assert all("keys=[], functions=[partial_" in line for line in below)


@pytest.mark.parametrize(
    "name, scan, pushed",
    [
        ("top_routes", "orders", "EqualTo(o_orderstatus,F)"),
        ("kpi_last_n_days", "orders", "GreaterThanOrEqual(o_orderdate"),
        ("scan_parquet", "orders", "GreaterThanOrEqual(o_orderdate"),
        ("incremental_extract", "orders", "GreaterThan(o_orderdate"),
    ],
)
def test_filters_reach_the_scan(spark, plans, name, scan, pushed):
    lines = [x for x in plan(spark, plans, name).splitlines() if "FileScan" in x and f"/{scan}.parquet" in x]
    # The calendar's span is taken over all days.
    lines = [x for x in lines if "ReadSchema: struct<o_orderdate:timestamp_ntz>" not in x]
    assert lines and all(pushed in x for x in lines)


def test_block_offsets_are_the_only_gathered_rows(spark, plans):
    """Row numbering gathers per-block counts, never the rows."""
    for name in ("surrogate_key", "rfm_scores"):
        lines = plan(spark, plans, name).splitlines()
        at = [i for i, x in enumerate(lines) if "Exchange SinglePartition" in x]
        assert at and all("HashAggregate(keys=[_block" in lines[i + 1] for i in at)


def test_columns_are_pruned(spark, plans):
    text = plan(spark, plans, "daily_trips")
    (scan,) = [x for x in text.splitlines() if "FileScan" in x and "/lineitem.parquet" in x]
    assert "l_tax" not in scan and "l_shipdate" not in scan


def test_partition_filter_prunes_folders(spark, plans):
    text = plan(spark, plans, "partition_pruned_scan")
    assert "PartitionFilters: [isnotnull(month_key" in text


def test_dimension_joins_carry_no_hint(spark):
    """Dimensions that grow with the data are not forced into a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(queries()["busiest_vehicles"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_reload_moves_its_rows_once_for_each_delivery(spark, tmp_path):
    """The rows of a delivery lie together by month and trip: no further exchange to find repeats."""
    from pyspark.sql import functions as F

    from starmart.operators import merge

    rows = spark.range(100).selectExpr("id % 3 AS month_key", "CAST(id % 40 AS STRING) AS trip_id", "id AS at")
    once = merge.latest_per_key(rows.repartitionByRange("month_key", "trip_id"), ["month_key", "trip_id"], [F.col("at")])
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and once.count() == 100


def test_lines_move_to_their_orders_without_computed_columns(spark):
    """Seconds are computed where line and order have met: they are no part of what the join moves."""
    from starmart.plans import adapters

    plan = adapters.lines_with_orders(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "second_of_day" in plan and "second_of_day" not in plan[plan.index("Join Inner"):]
