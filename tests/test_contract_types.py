"""The batch pipeline on the source contract's own types: text ids, integer trips, unknown stations and distances."""

import datetime as dt
from decimal import Decimal

from starmart.operators import scd1
from starmart.plans import analytics, marts, pipeline

T = dt.datetime
D = Decimal


def extracts(spark, trips):
    frame = spark.createDataFrame
    return pipeline.Extracts(
        users=frame(
            [(i, f"user{i}", f"u{i}@example.org", None, None, None, T(2024, 1, 1), "active", D("5.00")) for i in (1, 2)],
            "user_id int, username string, email string, first_name string, last_name string, date_of_birth date, "
            "registration_date timestamp_ntz, status string, balance decimal(10,2)",
        ),
        routes=frame(
            [(f"R{i:03d}", str(i), f"Line {i}", "bus", D("40.00"), True) for i in (1, 2, 10)],
            "route_id string, route_number string, route_name string, transport_type string, base_fare decimal(10,2), is_active boolean",
        ),
        stations=frame(
            [(f"ST{i:04d}", f"Stop {i}", "bus_stop", "Centre", 55.7, 37.6, "A", True) for i in (1, 2)],
            "station_id string, station_name string, station_type string, district string, latitude double, longitude double, zone string, is_active boolean",
        ),
        vehicles=frame(
            [("BUS_1", "bus", "R001", "Model", 50, 2020, dt.date(2025, 1, 1), "active")],
            "vehicle_id string, vehicle_type string, route_id string, model string, capacity int, manufacture_year int, "
            "last_maintenance_date date, status string",
        ),
        trips=frame(
            trips,
            "trip_id bigint, user_id int, route_id string, vehicle_id string, start_station_id string, end_station_id string, "
            "start_time timestamp_ntz, end_time timestamp_ntz, distance_km decimal(6,2), status string",
        ),
        transactions=frame(
            [(1, 1, 1, D("40.00"), "payment", "card", "success", T(2025, 3, 3, 8)), (2, 2, None, D("100.00"), "topup", "cash", "success", T(2025, 3, 3, 9))],
            "transaction_id bigint, user_id int, trip_id bigint, amount decimal(10,2), transaction_type string, payment_method string, "
            "status string, transaction_date timestamp_ntz",
        ),
    )


TRIPS = [
    (1, 1, "R001", "BUS_1", "ST0001", "ST0002", T(2025, 3, 3, 8), T(2025, 3, 3, 8, 30), D("4.00"), "completed"),
    (2, 1, "R002", None, None, None, T(2025, 3, 3, 9), None, None, "completed"),
    (3, 2, "R010", "BUS_1", "ST0002", "ST0001", T(2025, 3, 4, 9), T(2025, 3, 4, 10), D("2.00"), "cancelled"),
]


def test_pipeline_on_contract_types(spark, tmp_path):
    out = str(tmp_path / "dwh")
    loads = [(TRIPS[:1], dt.date(2025, 3, 1)), (TRIPS[1:], dt.date(2025, 3, 5))]  # the second load holds part of a day
    previous = None
    for n, (trips, day) in enumerate(loads):
        counts = pipeline.run(spark, extracts(spark, trips), out, day, T(2025, 3, day.day), previous=previous, load_id=n)
        previous = f"{out}/dims/202503{day.day:02d}T000000"
    rows = {r["table_name"]: r["row_count"] for r in counts.collect()}
    assert (rows["fact_trips"], rows["fact_transactions"], rows["dim_user"], rows["dim_route"]) == (3, 2, 2, 3)
    segments = {r.user_id: r.favorite_route_id for r in spark.read.parquet(f"{out}/marts/mart_user_segmentation").collect()}
    assert segments[1] == "R001" and len(segments) == 2
    payments = spark.read.parquet(f"{out}/fact_transactions").orderBy("transaction_id").collect()
    assert [r.trip_key for r in payments] == [1, None]


def test_averages_ignore_unknown_values(spark):
    fact = spark.createDataFrame(
        [(1, 1, 2, D("4.00"), D("6.00"), 3, "completed"), (1, 1, 2, None, None, None, "completed")],
        "vehicle_key int, start_station_key int, end_station_key int, distance_km decimal(6,2), actual_fare decimal(10,2), "
        "duration_minutes int, trip_status string",
    )
    stations = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "station_key int, station_id string, station_name string")
    assert analytics.top_station_pairs(fact, stations).first()["avg_distance"] == 4.0
    fleet = spark.createDataFrame(
        [(1, "bus", "active", None, 10), (2, "bus", "active", 4, None)],
        "vehicle_key int, vehicle_type string, current_status string, vehicle_age int, capacity int",
    )
    row = analytics.vehicle_type_stats(fact, fleet).first()
    assert (row["avg_age"], row["avg_capacity"]) == (4.0, 10.0)
    flow = spark.createDataFrame(
        [(1, 8, 2, 0, 1, 1, 0, 0, 2, 1, D("6.00"))] * 2,
        "date int, hour int, day_of_week int, is_weekend int, is_rush_hour int, bus_trips int, tram_trips int, metro_trips int, "
        "total_trips int, priced_trips int, total_revenue decimal(10,2)",
    )
    parts = flow.join(spark.range(2).selectExpr("hll_sketch_agg(id) AS passengers"))
    row = marts.collapse_flow(parts).first()
    assert (row["avg_revenue_per_trip"], row["unique_passengers"]) == (6.0, 2)


def test_a_repeated_snapshot_key_is_one_member(spark):
    dim = spark.createDataFrame([], "k string, sk bigint, v int, created_date timestamp_ntz, updated_date timestamp_ntz")
    snapshot = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    first = scd1.replace_attributes(dim, snapshot, "k", "sk", T(2025, 1, 1))
    again = scd1.replace_attributes(first, snapshot, "k", "sk", T(2025, 1, 2))
    assert sorted((r.k, r.v, r.sk) for r in again.collect()) == [("a", 2, 1), ("b", 1, 2)]
