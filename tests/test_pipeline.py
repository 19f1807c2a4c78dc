"""The batch pipeline from extracts to marts, run twice."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.plans import adapters as src
from starmart.plans import pipeline
from starmart.sources import writers

SF_DIR = "/root/testdata/sf0.001"


SINCE = dt.date(2001, 6, 20)
MARK = dt.datetime(2024, 12, 31)


def trips(spark):
    return src.trips(spark, SF_DIR, SINCE)


def extracts(spark):
    payments = src.transactions(spark, SF_DIR).where(F.col("transaction_date") >= F.lit(SINCE).cast("timestamp_ntz"))
    return pipeline.Extracts(
        users=src.users(spark, SF_DIR), routes=src.routes(spark, SF_DIR), stations=src.stations(spark, SF_DIR),
        vehicles=src.vehicles(spark, SF_DIR), trips=trips(spark), transactions=payments,
    )


def test_two_loads(spark, tmp_path):
    out = str(tmp_path / "dwh")
    span = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    # History starts before the first trip, so every trip finds its route version.
    first = pipeline.run(spark, extracts(spark), out, dt.date(1995, 1, 1), dt.datetime(1995, 1, 1), calendar_range=span)
    counts = {r["table_name"]: r["row_count"] for r in first.collect()}
    ridden = trips(spark).count()
    assert (counts["dim_user"], counts["dim_route"], counts["fact_trips"]) == (150, 200, ridden)
    assert counts["fact_transactions"] == extracts(spark).transactions.count() > 0

    raised = extracts(spark)
    new_routes = src.route_snapshot(spark, SF_DIR)
    raised = pipeline.Extracts(**{**vars(raised), "routes": new_routes})
    second = pipeline.run(
        spark, raised, out, dt.date(2001, 8, 1), dt.datetime(2001, 8, 1), previous=f"{out}/dims/19950101T000000", calendar_range=span
    )
    again = {r["table_name"]: r["row_count"] for r in second.collect()}
    assert again["fact_trips"] == ridden and again["dim_user"] == 150
    assert again["dim_route"] > counts["dim_route"]
    dims = spark.read.parquet(f"{out}/dims/20010801T000000/dim_route")
    assert dims.select("route_key").distinct().count() == dims.count()
    checks = spark.read.parquet(f"{out}/quality/20010801").collect()
    assert {r["check_result"] for r in checks} == {"passed"}
    assert spark.read.parquet(f"{out}/marts/mart_user_segmentation").count() == 150
    assert spark.read.parquet(f"{out}/marts/mart_route_performance").count() > 0
    assert spark.read.parquet(f"{out}/quarantine/20010801/fact_trips").count() == 0


def part_of(whole, first, last):
    day = F.col("start_time").cast("date")
    few = whole.trips.where(day.between(first, last))
    return pipeline.Extracts(**{**vars(whole), "trips": few, "transactions": whole.transactions.join(few.select("trip_id"), "trip_id", "left_semi")})


def test_a_part_extract_keeps_all_days_in_calendar_and_marts(spark, tmp_path):
    """The calendar comes from the data: a later load of five days must not shrink it, nor the marts."""
    out, whole = str(tmp_path / "dwh"), extracts(spark)
    as_of = dt.date(2001, 7, 20)
    first = pipeline.run(spark, whole, out, dt.date(1995, 1, 1), dt.datetime(1995, 1, 1))
    facts = {r["table_name"]: r["row_count"] for r in first.collect()}
    days = spark.read.parquet(f"{out}/dims/19950101T000000/dim_date").count()

    def marts():
        return {n: spark.read.parquet(f"{out}/marts/{n}").count() for n in ("mart_route_performance", "mart_route_hourly_stats")}

    some = part_of(whole, as_of, as_of + dt.timedelta(days=4))
    pipeline.run(spark, some, out, as_of, dt.datetime(2001, 7, 20), previous=f"{out}/dims/19950101T000000")
    before = marts()
    # Without the dimensions of the load before, the stored facts alone hold the calendar open.
    for load, previous in ((dt.datetime(2001, 7, 21), f"{out}/dims/20010720T000000"), (dt.datetime(2001, 7, 22), None)):
        counts = {r["table_name"]: r["row_count"] for r in pipeline.run(spark, some, out, as_of, load, previous=previous).collect()}
        assert counts["dim_date"] == days and counts["fact_trips"] == facts["fact_trips"]
        assert marts() == before


FACT = "trip_id long, start_date_key int, fare int, month_key int"


def stored(spark, path):
    return sorted(((r.trip_id, r.start_date_key, r.fare) for r in spark.read.schema(FACT).parquet(path).collect()), key=str)


def merge(spark, path, rows):
    full = [(t, d, f, d and d // 100) for t, d, f in rows]
    pipeline._merge_days(spark.createDataFrame(full, FACT), path, "start_date_key", "trip_id")


def test_merge_keeps_undated_rows_and_moves_changed_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    merge(spark, path, [(1, 20250101, 1), (2, 20250101, 1), (3, None, 1), (4, 20250301, 1)])
    merge(spark, path, [(5, None, 2), (2, 20250102, 2)])  # undated beside undated; 2 moves a day
    assert stored(spark, path) == sorted([(1, 20250101, 1), (2, 20250102, 2), (3, None, 1), (4, 20250301, 1), (5, None, 2)], key=str)
    merge(spark, path, [(1, 20250201, 3), (3, 20250102, 3), (4, None, 3)])  # the last row of a day leaves it
    want = [(1, 20250201, 3), (2, 20250102, 2), (3, 20250102, 3), (4, None, 3), (5, None, 2)]
    assert stored(spark, path) == sorted(want, key=str)
    merge(spark, path, [(1, 20250201, 3), (3, 20250102, 3), (4, None, 3)])  # delivered again
    assert stored(spark, path) == sorted(want, key=str)
    merge(spark, path, [(4, 20250101, 4), (5, 20250101, 4)])  # nothing undated is left
    assert [r for r in stored(spark, path) if r[1] is None] == []
    merge(spark, path, [])
    assert len(stored(spark, path)) == 5


def test_load_log_records_failure(spark, tmp_path):
    log, ticks = str(tmp_path / "log"), iter(dt.datetime(2025, 1, 1, h) for h in range(4))

    def broken():
        raise RuntimeError("no source")

    pipeline.log_load(spark, log, 1, "OLTP", "users", "full", lambda: next(ticks), lambda: (writers.write_counted(spark.range(7), str(tmp_path / "t")), MARK))
    try:
        pipeline.log_load(spark, log, 2, "OLTP", "users", "full", lambda: next(ticks), broken)
    except RuntimeError:
        pass
    from starmart.operators.control import load_state

    state = load_state(spark.read.parquet(log)).orderBy("load_id").collect()
    assert [(r["load_id"], r["status"], r["rows_inserted"], r["watermark_value"], r["error_message"]) for r in state] == [
        (1, "success", 7, MARK, None), (2, "failed", 0, None, "no source")
    ]
