"""Facts, upserts, control, quality, views and domain jobs on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import control, facts, merge, quality
from starmart.plans import analytics, domain, marts, views
from starmart.sources import readers, writers

T = dt.datetime


def test_upsert_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", "x", None), (2, "b", "y", None)], "id int, name string, kind string, at timestamp_ntz")
    source = spark.createDataFrame([(2, None, "new"), (3, "c", "z")], "id int, name string, kind string")
    stamp = ("at", T(2025, 1, 1))
    once = merge.upsert(target, source, ["id"], ["name"], stamp)
    rows = [tuple(r) for r in once.orderBy("id").collect()]
    assert rows == [(1, "a", "x", None), (2, None, "y", T(2025, 1, 1)), (3, "c", "z", None)]
    twice = merge.upsert(once, source, ["id"], ["name"], stamp).drop("at").orderBy("id").collect()
    assert twice == once.drop("at").orderBy("id").collect()


def test_upsert_of_each_source_row(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kind string")
    source = spark.createDataFrame([(2, "c", "z"), (2, "c", "z"), (3, "d", "z"), (3, "e", "z")], "id int, name string, kind string")
    rows = sorted(map(tuple, merge.upsert(target, source, ["id"], ["name"], each_row=True).collect()))
    assert rows == [(1, "a", "x"), (2, "c", "y"), (2, "c", "y"), (3, "d", "z"), (3, "e", "z")]
    with pytest.raises(Exception, match="repeats a key"):
        merge.upsert(target, source, ["id"], ["name"]).collect()


def test_latest_per_key_breaks_ties_by_row(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, v int, x string")
    out = merge.latest_per_key(df, ["k"], [F.col("v")]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, 5, "b"), (2, None, "n")]


def test_insert_if_absent_takes_one_row_per_key(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    source = spark.createDataFrame([(1, "z"), (2, "q"), (2, "p")], "id int, v string")
    assert sorted(map(tuple, merge.insert_if_absent(target, source, ["id"]).collect())) == [(1, "a"), (2, "p")]


def test_fares_come_from_payments_without_fan_out(spark):
    trips = spark.createDataFrame([(t, Decimal("50.00")) for t in ("t1", "t2", "t3")], "trip_id string, base_fare decimal(10,2)")
    pay = spark.createDataFrame(
        [("t1", "payment", "success", Decimal("10.00")), ("t1", "payment", "success", Decimal("5.00")),
         ("t2", "payment", "failed", Decimal("99.00")), (None, "topup", "success", Decimal("7.00"))],
        "trip_id string, transaction_type string, status string, amount decimal(10,2)",
    )
    out = facts.resolve_fares(trips, pay).orderBy("trip_id").collect()
    assert [(r["trip_id"], r["actual_fare"]) for r in out] == [("t1", Decimal("15.00")), ("t2", Decimal("50.00")), ("t3", Decimal("50.00"))]


def test_trip_facts_edges(spark):
    start = T(2025, 3, 1, 8, 0, 59)
    trips = spark.createDataFrame(
        [("a", 1, "R", "V", start, start + dt.timedelta(seconds=90), "S", "S", Decimal("1.00"), "completed"),
         ("b", 1, "R", None, start, None, None, "S", None, "in_progress"),
         ("c", 9, "R", "V", start, start - dt.timedelta(seconds=60), "S", None, Decimal("1.00"), "completed")],
        "trip_id string, user_id int, route_id string, vehicle_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "start_station_id string, end_station_id string, distance_km decimal(6,2), status string",
    )
    pay = spark.createDataFrame([], "trip_id string, transaction_type string, status string, amount decimal(10,2)")
    user = spark.createDataFrame([(1, 11)], "user_id int, user_key int")
    route = spark.createDataFrame(
        [("R", 21, Decimal("40.00"), dt.date(2025, 1, 1), dt.date(2025, 3, 1), False), ("R", 22, Decimal("45.00"), dt.date(2025, 3, 1), None, True)],
        "route_id string, route_key int, base_fare decimal(10,2), effective_date date, expiration_date date, is_current boolean",
    )
    vehicle = spark.createDataFrame([("V", 31)], "vehicle_id string, vehicle_key int")
    station = spark.createDataFrame([("S", 41)], "station_id string, station_key int")
    out = facts.trip_facts(trips, pay, user, route, vehicle, station, load_time=T(2025, 3, 2)).orderBy("trip_id").collect()
    assert [(r["user_key"], r["route_key"], r["vehicle_key"], r["start_station_key"], r["end_station_key"]) for r in out] == [
        (11, 22, 31, 41, 41), (11, 22, None, None, 41), (None, 22, 31, 41, None)
    ]
    assert [r["duration_minutes"] for r in out] == [2, None, -1]
    assert (out[0]["start_time_key"], out[0]["start_minute_key"], out[1]["end_date_key"]) == (80059, 80000, None)
    assert {r["actual_fare"] for r in out} == {Decimal("45.00")}
    early = trips.withColumn("start_time", F.lit(T(2025, 2, 1)).cast("timestamp_ntz"))
    for mode, key in (("as_of", 21), ("current", 22)):
        old = facts.trip_facts(early, pay, user, route, vehicle, station, route_key_mode=mode, load_time=T(2025, 3, 2))
        assert {r["route_key"] for r in old.collect()} == {key}


def test_transaction_without_trip_keeps_null_key(spark):
    txns = spark.createDataFrame(
        [("x", 1, None, Decimal("5.00"), "card", "topup", T(2025, 1, 1), "success"), ("y", 1, "t", Decimal("6.00"), "cash", "payment", T(2025, 1, 1), "success")],
        "transaction_id string, user_id int, trip_id string, amount decimal(10,2), payment_method string, transaction_type string, "
        "transaction_date timestamp_ntz, status string",
    )
    user = spark.createDataFrame([(1, 11)], "user_id int, user_key int")
    trips = spark.createDataFrame([("t", 77)], "trip_id string, trip_key int")
    methods = spark.createDataFrame([("card", 1), ("cash", 2)], "payment_method_code string, payment_method_key int")
    out = facts.transaction_facts(txns, user, trips, methods).orderBy("transaction_id").collect()
    assert [(r["transaction_id"], r["trip_key"], r["payment_method_key"]) for r in out] == [("x", None, 1), ("y", 77, 2)]


LOG = "load_id int, source_system string, table_name string, status string, load_end_time timestamp_ntz, watermark_value timestamp_ntz"


def test_watermarks(spark):
    log = spark.createDataFrame(
        [(1, "s", "a", "success", T(2025, 1, 1), T(2024, 12, 31)), (2, "s", "a", "success", T(2025, 1, 2), None),
         (3, "s", "a", "failed", T(2025, 1, 3), T(2025, 1, 3)), (4, "s", "b", "failed", T(2025, 1, 3), None),
         (5, "q", "a", "success", T(2025, 1, 1), T(2020, 1, 1))],
        LOG,
    )
    assert control.last_watermark(log, "s", "a") == T(2024, 12, 31)
    assert control.last_watermark(log, "s", "b") == control.last_watermark(log, "s", "none") == control.FIRST_WATERMARK
    assert control.last_watermark(log, "q", "a") == T(2020, 1, 1)


def test_load_records(spark):
    start = control.start_record(spark, 1, "OLTP", "users", "full", T(2025, 1, 1))
    end = control.end_records(start, "success", T(2025, 1, 1, 1), inserted=5, watermark=T(2024, 12, 31))
    state = control.load_state(start.unionByName(end)).collect()
    assert [(r["status"], r["rows_inserted"]) for r in state] == [("success", 5)]


def test_incremental_round(spark):
    df = spark.createDataFrame([(1, T(2025, 1, 1)), (2, T(2025, 1, 2))], "id int, at timestamp_ntz")
    newer = control.extract_newer(df, "at", T(2025, 1, 1))
    assert [r["id"] for r in newer.collect()] == [2]
    assert control.next_watermark(newer, "at", T(2025, 1, 1)) == T(2025, 1, 2)
    assert control.next_watermark(newer.where("id > 9"), "at", T(2025, 1, 2)) == T(2025, 1, 2)


def test_retention_counts_before_deleting(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2025, 1, d), d) for d in (1, 5, 5, 8, 9)], "load_day date, v int")
    cutoff = control.days_before(dt.date(2025, 1, 15), 7)
    row = control.retention_reports([("t", df, "load_day", cutoff)]).first()
    assert (row["rows_deleted"], row["rows_kept"]) == (3, 2)
    df.write.partitionBy("load_day").option("path", str(tmp_path / "t")).saveAsTable("retained")
    gone = control.drop_expired_partitions(spark, "retained", "load_day", cutoff).collect()
    assert sorted((r["load_day"].day, r["rows_deleted"]) for r in gone) == [(1, 1), (5, 2)]
    assert sorted(r["v"] for r in spark.table("retained").collect()) == [8, 9]
    spark.sql("DROP TABLE retained")


def test_years_before_leap_day():
    assert control.years_before(dt.date(2024, 2, 29), 3) == dt.date(2021, 2, 28)


def test_quality_results(spark):
    df = spark.createDataFrame([(1, "ok", 55.6), (1, "odd", 10.0), (None, None, 55.7)], "id int, status string, lat double")
    checks = [quality.not_null("id"), quality.in_domain("status", ["ok"]), quality.in_range("lat", 55.5, 56.0, soft=True), quality.max_length("status", 3)]
    out = {r["check_type"]: (r["actual_value"], r["check_result"]) for r in quality.run_checks(df, "t", checks).collect()}
    assert out == {"not_null": ("1", "failed"), "domain": ("1", "failed"), "range": ("1", "warning"), "length": ("0", "passed")}
    assert quality.unique_check(df, "t", ["id"]).first()["actual_value"] == "1"
    parents = spark.createDataFrame([(1,)], "pid int")
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "ref int")
    assert quality.foreign_key_check(child, parents, "ref", "pid", "t").first()["actual_value"] == "2"
    assert sorted(map(str, (r["ref"] for r in quality.cascade_delete(child, parents, "ref", "pid").collect()))) == ["1", "None"]
    assert sorted(map(str, (r["ref"] for r in quality.clear_reference(child, parents, "ref", "pid").collect()))) == ["1", "None", "None", "None"]
    with pytest.raises(ValueError):
        quality.restrict_delete(child, parents, "ref", "pid")


def test_latest_positions_keep_ties_and_drop_old(spark):
    now = T(2025, 1, 1, 12)
    rows = [(1, 1, now - dt.timedelta(minutes=5)), (2, 1, now - dt.timedelta(minutes=5)), (3, 1, now - dt.timedelta(minutes=9)), (4, 2, now - dt.timedelta(minutes=61))]
    pos = spark.createDataFrame(rows, "position_id int, vehicle_key int, recorded_at timestamp_ntz").withColumns(
        {"route_key": F.lit(1), "latitude": F.lit(0), "longitude": F.lit(0), "speed_kmh": F.lit(0), "direction_degree": F.lit(0)}
    )
    vehicles = spark.createDataFrame([(1, "a", "bus"), (2, "b", "bus")], "vehicle_key int, vehicle_id string, vehicle_type string")
    routes = spark.createDataFrame([(1, "R", "1", "one")], "route_key int, route_id string, route_number string, route_name string")
    out = views.latest_positions(pos, vehicles, routes, now).collect()
    assert sorted((r["position_id"], r["minutes_ago"]) for r in out) == [(1, 5.0), (2, 5.0)]


def fact(spark, rows):
    return spark.createDataFrame(
        rows, "user_key int, route_key int, start_date_key int, trip_status string, actual_fare decimal(10,2)"
    )


def test_rfm_counts_every_user(spark):
    users = spark.createDataFrame([(i, f"u{i}") for i in range(1, 6)], "user_key int, username string")
    trips = fact(spark, [(1, 1, 20250101, "completed", Decimal("5.00")), (2, 1, 20250102, "completed", Decimal("5.00")), (3, 1, 20250103, "cancelled", Decimal("5.00"))])
    out = {r["username"]: r for r in analytics.rfm_scores(trips, users, dt.date(2025, 1, 11)).collect()}
    assert len(out) == 5
    assert (out["u3"]["frequency"], out["u3"]["recency_days"], out["u3"]["monetary"]) == (0, None, None)
    assert (out["u1"]["recency_days"], out["u2"]["recency_days"]) == (10, 9)
    assert sorted(r["f_score"] for r in out.values()) == [1, 2, 3, 4, 5]
    # Equal monetary values fall apart by key.
    assert out["u1"]["m_score"] < out["u2"]["m_score"]


def test_segments_of_idle_users(spark):
    users = spark.createDataFrame([(1, 1, "a", dt.date(2024, 1, 1)), (2, 2, "b", dt.date(2024, 1, 1))], "user_key int, user_id int, username string, registration_date date")
    routes = spark.createDataFrame([(1, 7), (2, 5), (3, 5)], "route_key int, route_id int")
    rows = [(1, k, 20250110, "completed", Decimal("2.00")) for k in (1, 1, 2, 3)] + [(1, 1, 20240101, "cancelled", Decimal("2.00"))]
    out = {r["user_id"]: r for r in marts.user_segmentation(fact(spark, rows), users, routes, dt.date(2025, 1, 20)).collect()}
    a, b = out[1], out[2]
    assert (a["user_segment"], a["trips_last_30d"], a["avg_trips_per_week"], a["favorite_route_id"], a["favorite_route_trips"], a["days_since_last_trip"]) == (
        "rare", 4, Decimal("1.00"), "5", 2, 10
    )
    assert (b["user_segment"], b["trips_total"], b["favorite_route_id"], b["days_since_last_trip"], b["last_trip_date"]) == ("churned", 0, "N/A", 9999, None)


def test_user_statistics_do_not_fan_out(spark):
    users = spark.createDataFrame([(1, "a", "e", Decimal("0.00"), "active")], "user_id int, username string, email string, balance decimal(10,2), status string")
    trips = spark.createDataFrame([(1, "x", "completed", T(2025, 1, 1)), (1, "y", "cancelled", T(2025, 1, 2))], "user_id int, trip_id string, status string, start_time timestamp_ntz")
    txns = spark.createDataFrame([(1, "payment", "success", Decimal("3.00"))] * 3, "user_id int, transaction_type string, status string, amount decimal(10,2)")
    row = views.user_statistics(users, trips, txns).first()
    assert (row["total_trips"], row["completed_trips"], row["total_spent"]) == (2, 1, Decimal("9.00"))


def test_ledger(spark):
    kinds = [("topup", "success", 100), ("payment", "success", 30), ("refund", "success", 5), ("payment", "failed", 50), ("payment", "pending", 50)]
    rows = [(i, 1, T(2025, 1, 1 + i), k, s, Decimal(a)) for i, (k, s, a) in enumerate(kinds)]
    txns = spark.createDataFrame(rows, "transaction_id int, user_id int, transaction_date timestamp_ntz, transaction_type string, status string, amount decimal(10,2)")
    running = domain.running_balance(txns).orderBy("transaction_id").collect()
    assert [int(r["running_balance"]) for r in running] == [100, 70, 75, 75, 75]
    assert int(domain.account_balance(txns).first()["balance"]) == 75


def test_stationary_spells(spark):
    speeds = [0.5, 0.2, 5.0, 6.0, 0.1, 7.0, 0.0]
    rows = [(i, 1, T(2025, 1, 1, 8, i), s) for i, s in enumerate(speeds)]
    pings = spark.createDataFrame(rows, "position_id int, vehicle_id int, ts timestamp_ntz, speed double")
    out = domain.stationary_spells(pings).orderBy("spell").collect()
    assert [(r["stopped_at"].minute, r["until"].minute, r["slow_pings"], r["moved_on"]) for r in out] == [(0, 2, 2, True), (4, 5, 1, True), (6, 6, 1, False)]


def test_route_reachability_against_brute_force(spark):
    stops = spark.createDataFrame([(r, f"{r}{i}", i, i % 3 + 1, Decimal(i)) for r in (1, 2) for i in range(1, 6 + r)], "route_id int, station_id string, n int, travel_minutes int, distance_km decimal(5,2)")
    numbered = domain.number_stops(stops, [F.col("n")])
    rows = numbered.collect()
    ahead = {(r["route_id"], r["seq"]): r["stops_ahead"] for r in domain.downstream(numbered).collect()}
    for a in rows:
        assert ahead[(a["route_id"], a["seq"])] == sum(b["route_id"] == a["route_id"] and b["seq"] > a["seq"] for b in rows)
    asked = spark.createDataFrame([(1, 1, 3), (1, 3, 1), (1, 2, 2), (2, 1, 99), (9, 1, 2)], "route_id int, start_seq long, end_seq long")
    out = {(r["route_id"], r["start_seq"], r["end_seq"]): (r["feasible"], r["ride_km"]) for r in domain.legs(asked, numbered).collect()}
    assert out == {(1, 1, 3): (True, Decimal(5)), (1, 3, 1): (False, None), (1, 2, 2): (False, None), (2, 1, 99): (False, None), (9, 1, 2): (False, None)}


def test_search_funnel(spark):
    rows = [(1, "[]", 5), (2, '[{"route_id": 5}]', 5), (3, '[{"route_id": 5}]', 6), (4, None, 6), (5, '[{"route_id": 5}]', None)]
    out = domain.search_funnel(spark.createDataFrame(rows, "id int, s string, r long"), "s", "r").orderBy("id").collect()
    assert [(r["suggestions"], r["selection"]) for r in out] == [(0, "other"), (1, "suggested"), (1, "other"), (0, "other"), (1, "none")]


def test_subscriptions(spark):
    d = dt.date
    rows = [(1, "m", d(2025, 1, 1), d(2025, 1, 10)), (1, "m", d(2025, 1, 10), d(2025, 1, 12)), (2, "m", d(2025, 1, 1), d(2025, 1, 5)), (2, "m", d(2025, 1, 6), d(2025, 1, 8))]
    subs = spark.createDataFrame(rows, "user_id int, subscription_type string, start_date date, end_date date")
    out = {r["user_id"]: (r["subscriptions"], r["most_at_once"], r["days_overlapping"]) for r in domain.subscription_overlaps(subs).collect()}
    assert out == {1: (2, 2, 1), 2: (2, 1, 0)}
    level = {r["day"].day: r["active"] for r in domain.subscription_coverage(subs).collect()}
    assert level == {1: 2, 6: 2, 9: 1, 10: 2, 11: 1, 13: 0}


def test_station_popularity_arrival_only_days(spark):
    trips = spark.createDataFrame([(1, 1, 2, 20250110, "completed")], "user_key int, start_station_key int, end_station_key int, start_date_key int, trip_status string")
    stations = spark.createDataFrame([(i, i, "n", "t", "d") for i in (1, 2)], "station_key int, station_id int, station_name string, station_type string, district string")
    days = spark.createDataFrame([(20250110, dt.date(2025, 1, 10))], "date_key int, date date")
    got = {how: {r["station_id"]: (r["departures_count"], r["arrivals_count"], r["unique_users"]) for r in marts.station_popularity(trips, stations, days, dt.date(2025, 1, 20), how).collect()} for how in ("left", "full_outer")}
    assert got == {"left": {1: (1, 0, 1)}, "full_outer": {1: (1, 0, 1), 2: (0, 1, 1)}}


def test_jdbc_options():
    whole = readers.jdbc_options("jdbc:x:y", table="t", partition_column="id", lower=0, upper=9, partitions=4)
    assert (whole["dbtable"], whole["partitionColumn"], whole["numPartitions"]) == ("t", "id", "4")
    assert readers.jdbc_options("jdbc:x:y", query="select 1")["query"] == "select 1"
    assert readers.jdbc_options("u", query="q", partition_column="id", lower=0, upper=9)["dbtable"] == "(q) q"
    with pytest.raises(ValueError):
        readers.jdbc_options("u")
    with pytest.raises(ValueError):
        readers.jdbc_options("u", table="t", partition_column="id")


def test_read_or_empty(spark, tmp_path):
    df = spark.range(3)
    assert readers.read_or_empty(spark, str(tmp_path / "none"), df.schema).count() == 0
    df.write.parquet(str(tmp_path / "some"))
    assert readers.read_or_empty(spark, str(tmp_path / "some"), df.schema).count() == 3


def test_replace_partitions_and_truncate(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "day int, v int")
    writers.replace_partitions(df, path, ["day"], ["v"])
    writers.replace_partitions(df.where("day = 2").withColumn("v", F.lit(99)), path, ["day"])
    assert sorted((r["day"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 99)]
    writers.truncate(str(tmp_path / "u"), df.schema, spark)
    assert spark.read.parquet(str(tmp_path / "u")).count() == 0


def test_merged_flow_counts_passengers_exactly(spark):
    """20 000 users of one hour in three overlapping loads: a sketch would miss their number."""
    fact = spark.range(60000).selectExpr(
        "id % 20000 AS user_key", "1 AS route_key", "20250103 AS start_date_key", "80000 AS start_minute_key",
        "CAST(2 AS DECIMAL(10,2)) AS actual_fare", "'completed' AS trip_status", "id % 7 % 3 AS load",
    )
    routes = spark.createDataFrame([(1, "bus")], "route_key int, transport_type string")
    days = spark.createDataFrame([(20250103, T(2025, 1, 3).date(), 6, False)], "date_key int, date date, day_of_week int, is_weekend boolean")
    minutes = spark.createDataFrame([(80000, 8, True)], "time_key int, hour int, is_rush_hour boolean")
    parts = marts.flow_parts(fact, routes, days, minutes, F.col("load"), exact=True)
    row = marts.collapse_flow(parts).first()
    assert (row["bus_trips"], row["total_trips"], row["total_revenue"], row["unique_passengers"]) == (60000, 60000, Decimal(120000), 20000)
