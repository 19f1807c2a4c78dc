"""Streaming jobs: decoding, late data, duplicates, agreement with batch."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.plans import domain
from starmart.sources import readers
from starmart.streaming import pings as streaming

GOOD = {"vehicle_id": "BUS_1", "route_id": "R1", "latitude": 55.7, "longitude": 37.6, "speed": 10.0, "bearing": 90,
        "occupancy": "empty", "timestamp": "2024-03-05T06:07:08Z", "vehicle_type": "bus"}


def test_decode_separates_dead_letters(spark):
    lines = [json.dumps(GOOD), json.dumps(GOOD)[:40], "", json.dumps({**GOOD, "timestamp": "soon"}), json.dumps({**GOOD, "vehicle_id": None})]
    decoded = streaming.decode(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r["error"] for r in streaming.dead_letters(decoded).collect()) == ["bad timestamp", "malformed", "malformed", "no vehicle"]
    row = streaming.good(decoded).first()
    assert (row["vehicle_id"], row["speed"], row["ts"]) == ("BUS_1", 10.0, dt.datetime(2024, 3, 5, 6, 7, 8))


SCHEMA = T.StructType(
    [T.StructField("position_id", T.LongType()), T.StructField("vehicle_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("speed", T.DoubleType())]
)


def batches(spark, folder, *groups):
    """One file, hence one micro-batch, per group of (id, vehicle, minute, speed)."""
    for n, rows in enumerate(groups):
        start = dt.datetime(2025, 1, 1)
        data = [(i, v, start + dt.timedelta(minutes=m), s) for i, v, m, s in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in/g{n}")
    return readers.stream_files(spark, f"{folder}/in/*", SCHEMA, max_files=1, latestFirst="false")


def collect(spark, df, folder, reached=None):
    mark = streaming.run_to_table(df, f"{folder}/out", f"{folder}/cp")
    assert reached is None or mark == reached
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def test_late_and_duplicate_pings(spark, tmp_path):
    stream = batches(
        spark, tmp_path,
        [(1, 1, 0, 1.0), (1, 1, 0, 1.0), (2, 1, 20, 1.0)],
        [(3, 1, 15, 1.0), (2, 1, 20, 1.0), (4, 1, 60, 1.0)],   # 15 is within the watermark of 20 - 10
        [(5, 1, 5, 1.0), (6, 1, 61, 1.0)],                      # 5 is too late
    )
    out = collect(spark, streaming.deduplicate(streaming.with_event_time(stream)).select("position_id"), tmp_path, dt.datetime(2025, 1, 1, 0, 51))
    assert sorted(r["position_id"] for r in out.collect()) == [1, 2, 3, 4, 6]


def test_spells_cross_batches(spark, tmp_path):
    groups = [[(1, 1, 0, 0.5), (2, 1, 1, 0.2), (3, 2, 1, 9.0)], [(4, 1, 2, 0.3), (5, 1, 3, 8.0), (6, 2, 3, 0.1)], [(7, 2, 9, 5.0), (8, 1, 9, 0.0)], [(9, 9, 60, 9.0)]]
    stream = batches(spark, tmp_path, *groups)
    out = collect(spark, streaming.stationary_spells(streaming.with_event_time(stream)), tmp_path)
    got = sorted((r["vehicle_id"], r["delay_minutes"], r["slow_pings"]) for r in out.collect())
    pings = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    batch = domain.stationary_spells(pings).where("moved_on")
    assert got == sorted((r["vehicle_id"], r["delay_minutes"], r["slow_pings"]) for r in batch.collect()) == [(1, 3.0, 3), (2, 6.0, 1)]


def test_append_survives_replay(spark, tmp_path):
    handle = streaming.append_batches(str(tmp_path / "a"), ["m"], "first")
    df = spark.createDataFrame([(1, 202501), (2, 202502)], "v int, m int")
    for n in (0, 1, 1):
        handle(df, n)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_a_new_checkpoint_loses_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 202501), (2, 202502)], "v int, m int")
    for run in ("first", "second"):
        streaming.append_batches(str(tmp_path / "a"), ["m"], run)(df, 0)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_pings_of_an_unlisted_occupancy_count(spark):
    pings = spark.createDataFrame([("R1", dt.datetime(2025, 1, 1), "full"), ("R1", dt.datetime(2025, 1, 1), "odd")], "route_id string, ts timestamp, occupancy string")
    levels = spark.createDataFrame([("full", 4)], "occupancy_code string, occupancy_level int")
    assert {(r.pings, r.avg_level) for r in streaming.sliding_load(pings, levels).collect()} == {(2, 4.0)}


def test_delay_state_over_batches_and_string_ids(spark, tmp_path):
    speeds = [0.5, 0.2, 5.0, 0.3, 0.1, 0.2, 9.0, 8.0, 0.0, 7.0]
    rows = [(i, v, dt.datetime(2025, 1, 1, 8, i), s) for v in ("V-1", "V-2") for i, s in enumerate(speeds)]
    schema = "position_id int, vehicle_id string, ts timestamp_ntz, speed double"
    rows.append((12, "V-9", dt.datetime(2025, 1, 1, 9, 30), 50.0))  # moves the watermark past the others
    for n in range(5):
        spark.createDataFrame([r for r in rows if r[0] // 3 == n], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = readers.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=8)
        spells = streaming.stationary_spells(streaming.with_event_time(stream))
        streaming.run_to_table(spells, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = sorted((r.vehicle_id, r.stopped_at.minute, r.until.minute, r.slow_pings) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(v, *x) for v in ("V-1", "V-2") for x in ((0, 2, 2), (3, 6, 3), (8, 9, 1))]


def test_pings_out_of_order_late_and_without_speed(spark, tmp_path):
    """Within the watermark order of arrival does not matter; behind it a ping is left out."""
    stream = batches(
        spark, tmp_path,
        [(1, 1, 3, 0.1), (2, 1, 9, 0.0)],
        [(3, 1, 5, 0.2), (4, 1, 1, 9.0)],                   # in between, and before
        [(5, 1, 11, 8.0), (6, 1, 12, 0.0), (7, 2, 40, 5.0)],  # 40 sends the watermark to 30
        [(8, 1, 4, 9.0), (9, 1, 32, None)],                  # 4 is late; no speed is no stop
        [(10, 2, 90, 5.0)],
    )
    out = collect(spark, streaming.stationary_spells(streaming.with_event_time(stream)), tmp_path)
    assert sorted((r.vehicle_id, r.delay_minutes, r.slow_pings) for r in out.collect()) == [(1, 8.0, 3), (1, 20.0, 1)]


def test_a_silent_vehicle_is_forgotten(spark, tmp_path):
    stream = batches(
        spark, tmp_path, [(1, 1, 0, 0.1), (2, 2, 0, 0.1)], [(3, 3, 100, 5.0)], [(4, 2, 101, 5.0), (5, 3, 400, 5.0)],
        [(6, 1, 401, 5.0), (7, 3, 900, 5.0)],
    )
    spells = streaming.stationary_spells(streaming.with_event_time(stream), forget_after=dt.timedelta(hours=3))
    out = collect(spark, spells, tmp_path)
    # Vehicle 1 moved again only after its state was gone: nobody knows how long it stood.
    assert [(r.vehicle_id, r.delay_minutes) for r in out.collect()] == [(2, 101.0)]


def test_spells_of_many_vehicles_share_a_bounded_number_of_states(spark, tmp_path):
    """2000 vehicles and pings without a vehicle or an id in buckets: few states, the spells of the batch job."""
    for n in range(3):
        spark.range(6000).selectExpr(
            f"NULLIF(id, 17) + {n} * 6000 AS position_id", "NULLIF(id % 2000, 5) AS vehicle_id",
            f"timestampadd(SECOND, CAST(id % 3000 AS INT) + {n} * 3600, TIMESTAMP_NTZ'2025-01-01 08:00:00') AS ts", f"CAST((id * 7 + {n}) % 11 AS DOUBLE) AS speed",
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = readers.stream_files(spark, str(tmp_path / "in"), SCHEMA, max_files=1, latestFirst="false")
    last = spark.createDataFrame([(99999, 9999, dt.datetime(2025, 1, 2), 0.0)], SCHEMA)
    last.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spells = streaming.stationary_spells(streaming.with_event_time(stream), slow_below=5.0)
    query = (
        spells.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 6 * streaming.SPELL_BUCKETS
    pings = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    batch = domain.stationary_spells(pings, slow_below=5.0).where("moved_on")
    columns = ["vehicle_id", "stopped_at", "slow_pings"]
    got, want = (sorted(map(str, df.select(*[F.col(c).cast("string") for c in columns]).collect())) for df in (spark.read.schema(spells.schema).parquet(str(tmp_path / "out")), batch))
    assert got == want and len(got) > 2000


def test_state_of_hourly_speed_is_bounded_by_distinct_speeds(spark, tmp_path):
    start = dt.datetime(2025, 1, 1, 8)
    schema = "vehicle_id int, route_id string, ts timestamp_ntz, speed decimal(5,2)"
    for n in range(4):  # 4000 pings of one hour at 5 speeds, in four micro-batches
        rows = [(k % 40, "R1", start + dt.timedelta(seconds=900 * n + k % 900), Decimal(10 * (k % 5))) for k in range(1000)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = readers.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=1)
    hours = streaming.hourly_speed(streaming.with_event_time(stream))
    query = (
        hours.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert len(query.recentProgress) >= 4 and max(states) == 5


def test_median_and_vehicles_over_several_batches(spark, tmp_path):
    start = dt.datetime(2025, 1, 1, 8)
    schema = "vehicle_id int, route_id string, ts timestamp_ntz, speed decimal(5,2)"
    speeds = [Decimal(x) for x in ("1.00", "2.00", "2.00", "10.00")] + [None]
    for n, part in enumerate([[0, 1], [2, 3, 4]]):
        rows = [(k % 3, "R1", start + dt.timedelta(minutes=10 * k), speeds[k]) for k in part]
        rows += [(9, "R2", start + dt.timedelta(hours=3), None)] if n else []
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = readers.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=1)
        hours = streaming.hourly_speed(streaming.with_event_time(stream))
        streaming.run_to_table(hours, str(tmp_path / "out"), str(tmp_path / "cp"))
    row = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.avg_speed, r.median_speed, r.min_speed, r.max_speed, r.measurements_count, r.active_vehicles) for r in row] == [
        (3.75, 2.0, Decimal("1.00"), Decimal("10.00"), 5, 3)
    ]


def test_vehicles_of_an_hour_are_counted_exactly(spark, tmp_path):
    """5000 vehicles at three speeds, twice: a sketch would miss their number."""
    rows = spark.range(30000).selectExpr(
        "CAST(id % 5000 AS INT) AS vehicle_id", "'R1' AS route_id", "timestampadd(SECOND, CAST(id % 3600 AS INT), TIMESTAMP_NTZ'2025-01-01 08:00:00') AS ts",
        "CAST(id % 3 AS DECIMAL(5,2)) AS speed",
    )
    later = rows.limit(1).selectExpr("vehicle_id", "route_id", "TIMESTAMP_NTZ'2025-01-01 12:00:00' AS ts", "speed")
    for part in (rows, later):
        part.write.mode("append").parquet(str(tmp_path / "in"))
        hours = streaming.hourly_speed(streaming.with_event_time(readers.stream_files(spark, str(tmp_path / "in"), rows.schema, max_files=64)))
        streaming.run_to_table(hours, str(tmp_path / "out"), str(tmp_path / "cp"))
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.measurements_count, r.active_vehicles, r.median_speed) for r in found] == [(30000, 5000, 1.0)]
