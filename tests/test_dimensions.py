"""Type-1 and type-2 dimensions, calendar, keys, buckets."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart import functions as fn
from starmart.operators import calendar, scd1, scd2, surrogate

D = dt.date
HISTORY = (
    "route_key bigint, route_id string, base_fare decimal(10,2), route_name string, effective_date date, "
    "expiration_date date, is_current boolean, version int"
)
SNAPSHOT = "route_id string, base_fare decimal(10,2), route_name string"
TRACKED = ["base_fare", "route_name"]


def load(spark, history, rows, day, **kw):
    snapshot = spark.createDataFrame(rows, SNAPSHOT)
    return scd2.apply_snapshot(history, snapshot, "route_id", "route_key", TRACKED, day, **kw)


def versions(df, *columns):
    columns = columns or ("route_id", "base_fare", "effective_date", "expiration_date", "is_current", "version")
    return [tuple(r) for r in df.orderBy("route_id", "version").select(*columns).collect()]


def fare(text):
    return None if text is None else Decimal(text)


def test_worked_example(spark):
    empty = spark.createDataFrame([], HISTORY)
    first = load(spark, empty, [("R45", fare("50.00"), "Line 45")], D(2025, 1, 1))
    second = load(spark, first, [("R45", fare("55.00"), "Line 45")], D(2025, 7, 1))
    assert versions(second) == [
        ("R45", fare("50.00"), D(2025, 1, 1), D(2025, 7, 1), False, 1),
        ("R45", fare("55.00"), D(2025, 7, 1), None, True, 2),
    ]


def test_null_new_vanished_unchanged_duplicate(spark):
    history = load(
        spark, spark.createDataFrame([], HISTORY),
        [("A", None, "a"), ("B", fare("2.00"), "b"), ("C", fare("3.00"), "c"), ("V", fare("4.00"), "v")], D(2025, 1, 1),
    )
    rows = [("A", fare("1.00"), "a"), ("B", None, "b"), ("C", fare("3.00"), "c"), ("N", fare("9.00"), "n"), ("N", fare("8.00"), "n")]
    snapshot = spark.createDataFrame(rows, SNAPSHOT)
    actions = {r["route_id"]: r["action"] for r in scd2.diff(history, snapshot, "route_id", TRACKED, D(2025, 2, 1)).collect()}
    assert actions == {"A": "changed", "B": "changed", "C": "unchanged", "N": "new", "V": "vanished"}
    kept = load(spark, history, rows, D(2025, 2, 1))
    assert versions(kept, "route_id", "base_fare", "version", "is_current") == [
        ("A", None, 1, False), ("A", fare("1.00"), 2, True), ("B", fare("2.00"), 1, False), ("B", None, 2, True),
        ("C", fare("3.00"), 1, True), ("N", fare("9.00"), 1, True), ("V", fare("4.00"), 1, True),
    ]
    closed = load(spark, history, rows, D(2025, 2, 1), close_missing=True).where("route_id = 'V'")
    assert versions(closed, "expiration_date", "is_current") == [(D(2025, 2, 1), False)]
    keys = [r["route_key"] for r in kept.select("route_key").collect()]
    assert sorted(keys) == list(range(1, 8))


def test_same_day_change_amends(spark):
    history = load(spark, spark.createDataFrame([], HISTORY), [("A", fare("1.00"), "a")], D(2025, 1, 1))
    again = load(spark, history, [("A", fare("2.00"), "a")], D(2025, 1, 1))
    assert versions(again) == [("A", fare("2.00"), D(2025, 1, 1), None, True, 1)]


def test_same_load_twice_changes_nothing(spark):
    rows = [("A", fare("1.00"), "a"), ("B", fare("2.00"), "b")]
    history = load(spark, spark.createDataFrame([], HISTORY), rows, D(2025, 1, 1))
    assert versions(load(spark, history, rows, D(2025, 1, 2))) == versions(history)


def test_invariants_hold_after_random_loads(spark):
    rng = random.Random(7)
    history = spark.createDataFrame([], HISTORY)
    for day in (1, 1, 2, 5):
        rows = [(f"R{i}", fare(f"{rng.randint(1, 3)}.00"), "n") for i in range(12) if rng.random() < 0.8]
        history = load(spark, history, rows, D(2025, 3, day), close_missing=rng.random() < 0.5)
    found = scd2.invariants(history, "route_id").first().asDict()
    assert found.pop("members") > 0
    # A route that vanished and came back leaves a gap; nothing else may be wrong.
    found.pop("gaps")
    assert set(found.values()) == {0}


def test_as_of_lookup_is_half_open(spark):
    history = spark.createDataFrame(
        [(1, "A", fare("1"), "a", D(2025, 1, 1), D(2025, 7, 1), False, 1), (2, "A", fare("2"), "a", D(2025, 7, 1), None, True, 2)],
        HISTORY,
    )
    asked = [("A", D(2024, 12, 31)), ("A", D(2025, 1, 1)), ("A", D(2025, 6, 30)), ("A", D(2025, 7, 1)), ("A", D(2030, 1, 1)), ("X", D(2025, 3, 1))]
    found = scd2.as_of_join(spark.createDataFrame(asked, "id string, day date"), history.withColumnRenamed("route_id", "id"), "id", "day", ["route_key"])
    assert [r["route_key"] for r in found.orderBy("id", "day").collect()] == [None, 1, 1, 2, 2, None]


def test_history_from_feed_drops_repeats(spark):
    feed = spark.createDataFrame(
        [(1, D(2025, 1, d), v) for d, v in ((1, "a"), (2, "a"), (3, "b"), (5, "a"))], "id int, day date, v string"
    )
    rows = scd2.history_from_feed(feed, "id", "v", "day").orderBy("version").collect()
    assert [(r["v"], r["effective_date"].day, r["expiration_date"] and r["expiration_date"].day, r["version"]) for r in rows] == [
        ("a", 1, 3, 1), ("b", 3, 5, 2), ("a", 5, None, 3)
    ]


def test_type_one_keeps_keys(spark):
    now, before = dt.datetime(2025, 2, 1), dt.datetime(2025, 1, 1)
    dim = spark.createDataFrame(
        [(7, 1, "old", before, before), (9, 2, "gone", before, before)],
        "user_key bigint, user_id bigint, name string, created_date timestamp_ntz, updated_date timestamp_ntz",
    )
    snapshot = spark.createDataFrame([(1, "new"), (3, "c"), (4, "d")], "user_id bigint, name string")
    out = scd1.replace_attributes(dim, snapshot, "user_id", "user_key", now).orderBy("user_id").collect()
    assert [(r["user_key"], r["user_id"], r["name"], r["created_date"], r["updated_date"]) for r in out] == [
        (7, 1, "new", before, now), (9, 2, "gone", before, before), (10, 3, "c", now, now), (11, 4, "d", now, now)
    ]


def test_unresolved_keys_are_listed(spark):
    fact = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "u int, r int")
    good, bad = surrogate.split_unresolved(fact, ["u", "r"])
    assert good.count() == 1
    assert sorted(r["unresolved"] for r in bad.collect()) == ["u", "u,r"]


def test_calendar_golden(spark):
    days = calendar.date_dimension(spark, D(2024, 1, 1), D(2026, 12, 31))
    checks = {r["table_name"]: r for r in calendar.calendar_check(days, calendar.time_dimension(spark)).collect()}
    d, t = checks["dim_date"], checks["dim_time"]
    assert (d["total_rows"], d["weekend_days"], d["holiday_days"]) == (1096, 312, 42)
    assert (t["total_rows"], t["rush_hour_records"]) == (1440, 360)
    row = days.where("date = DATE'2024-12-30'").first()
    assert (row["week"], row["year"], row["day_of_week"], row["day_name"], row["month_name"]) == (1, 2024, 2, "Monday", "December")


def test_age_groups(spark):
    births = [None, D(2010, 1, 1), D(2007, 12, 31), D(2000, 1, 1), D(1999, 6, 1), D(1989, 1, 1), D(1975, 1, 1), D(1970, 1, 1)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(births)], "i int, b date")
    out = [r[0] for r in df.orderBy("i").select(fn.age_group(F.col("b"), D(2025, 5, 1))).collect()]
    assert out == ["unknown", "under 18", "18-25", "18-25", "26-35", "36-50", "36-50", "51+"]


def test_maintenance_boundaries(spark):
    df = spark.range(1).select(
        *[fn.maintenance_status(F.lit(D(2025, 3, 31) - dt.timedelta(days=n)), D(2025, 3, 31)).alias(str(n)) for n in (0, 30, 31, 60, 61)]
    )
    assert list(df.first()) == ["up_to_date", "up_to_date", "due_soon", "due_soon", "overdue"]


@pytest.mark.parametrize("seconds, minutes", [(29, 0), (30, 1), (31, 1), (89, 1), (90, 2)])
def test_duration_rounds_half_up(spark, seconds, minutes):
    start = dt.datetime(2025, 1, 1, 8)
    df = spark.createDataFrame([(start, start + dt.timedelta(seconds=seconds))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(fn.duration_minutes("a", "b")).first()[0] == minutes


def test_overlapping_occupancy_ranges(spark):
    asked = spark.createDataFrame([(p,) for p in (0, 20, 21, 80, 81, 95, 100, None)], "p int")
    best = asked.select("p", fn.occupancy_code(F.col("p")).alias("c")).collect()
    assert {r["p"]: r["c"] for r in best} == {
        0: "empty", 20: "empty", 21: "many_seats_available", 80: "standing_room_only", 81: "crushed_standing_room_only",
        95: "full", 100: "full", None: None,
    }


def random_history(rng, members):
    """Versions with gaps, open and empty ends, and a member that changes daily."""
    rows = []
    for m in range(members):
        day = D(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 400))
        for v in range(rng.randint(1, 40)):
            length = 1 if m == 0 else rng.choice([1, 3, 29, 31, 200, 700])
            end = None if rng.random() < 0.1 else day + dt.timedelta(days=length)
            rows.append((f"m{m}", 100 * m + v, day, end))
            if end is None:
                break
            day = end + dt.timedelta(days=rng.choice([0, 0, 0, 5]))
    return rows


def test_as_of_join_equals_a_search(spark):
    rng = random.Random(9)
    versions_of = random_history(rng, 25)
    history = spark.createDataFrame(versions_of, "id string, route_key int, effective_date date, expiration_date date")
    asked = [
        (rng.choice([f"m{rng.randint(0, 26)}", None]), rng.choice([None, D(2019, 1, 1), D(2099, 1, 31)] + [D(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 3000))] * 30))
        for _ in range(3000)
    ]
    found = scd2.as_of_join(spark.createDataFrame(asked, "id string, day date"), history, "id", "day", ["route_key"])
    want = []
    for member, day in asked:
        keys = [k for i, k, a, b in versions_of if i == member and day and a <= day and (b is None or day < b)]
        want += [(member, day, k) for k in keys or [None]]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_as_of_join_meets_versions_of_its_month_only(spark):
    """A member with 3000 daily versions: each of its rows meets at most a month of them."""
    rows = [("a", k, D(2015, 1, 1) + dt.timedelta(days=k), D(2015, 1, 2) + dt.timedelta(days=k)) for k in range(3000)]
    history = spark.createDataFrame(rows, "id string, route_key int, effective_date date, expiration_date date")
    dealt, tail = scd2._by_month(history, "id", ["route_key"])
    assert dealt.count() == 3000 and tail == D(2023, 3, 1)
    assert dealt.groupBy("_id", "_month").count().agg(F.max("count")).first()[0] == 31
    asked = spark.createDataFrame([("a", D(2016, 2, 29))], "id string, day date")
    joined = scd2.as_of_join(asked, history, "id", "day", ["route_key"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "_row_month" in join and "_month" in join and [r.route_key for r in joined.collect()] == [424]


def test_as_of_join_without_history(spark):
    history = spark.createDataFrame([], "id string, route_key int, effective_date date, expiration_date date")
    asked = spark.createDataFrame([("a", D(2020, 1, 1))], "id string, day date")
    assert [tuple(r) for r in scd2.as_of_join(asked, history, "id", "day", ["route_key"]).collect()] == [("a", D(2020, 1, 1), None)]


def test_stamps_of_versions(spark):
    stamped = HISTORY + ", created_date timestamp_ntz, updated_date timestamp_ntz, source_system string"
    first, second, third = (dt.datetime(2025, m, 1, 6) for m in (1, 2, 3))
    rows = [("A", fare("1.00"), "a"), ("B", fare("2.00"), "b")]
    history = load(spark, spark.createDataFrame([], stamped), rows, D(2025, 1, 1), load_time=first)
    changed = load(spark, history, [("A", fare("9.00"), "a"), rows[1]], D(2025, 2, 1), load_time=second)
    amended = load(spark, changed, [("A", fare("8.00"), "a"), ("B", fare("2.00"), "b")], D(2025, 2, 1), load_time=third)
    assert versions(amended, "route_id", "version", "created_date", "updated_date", "source_system") == [
        ("A", 1, first, second, "OLTP"), ("A", 2, second, third, "OLTP"), ("B", 1, first, first, "OLTP"),
    ]


def test_as_of_join_deals_long_histories_only(spark):
    """Many members of few versions and one of daily ones: only the latter is dealt by month."""
    daily = [("a", k, D(2015, 1, 1) + dt.timedelta(days=k), D(2015, 1, 2) + dt.timedelta(days=k)) for k in range(1000)]
    few = [(f"m{k}", -k, D(2015, 1, 1), None) for k in range(50)]
    schema = "id string, route_key int, effective_date date, expiration_date date"
    asked = spark.createDataFrame([("a", D(2016, 2, 29)), ("m7", D(2016, 2, 29)), ("m7", D(2014, 1, 1)), ("x", D(2016, 1, 1))], "id string, day date")
    short = scd2.as_of_join(asked, spark.createDataFrame(few, schema), "id", "day", ["route_key"])
    assert "_month" not in short._jdf.queryExecution().optimizedPlan().toString()
    found = scd2.as_of_join(asked, spark.createDataFrame(daily + few, schema), "id", "day", ["route_key"])
    assert found.columns == ["id", "day", "route_key"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [("a", D(2016, 2, 29), 424), ("m7", D(2016, 2, 29), -7), ("m7", D(2014, 1, 1), None), ("x", D(2016, 1, 1), None)])
    )


def test_each_row_of_a_repeated_key_is_applied(spark):
    history = load(spark, spark.createDataFrame([], HISTORY), [("A", fare("1.00"), "a"), ("B", fare("2.00"), "b")], D(2025, 1, 1))
    rows = [("A", fare("1.00"), "a"), ("A", fare("1.00"), "a"), ("B", fare("3.00"), "b"), ("N", fare("9.00"), "n"), ("N", fare("8.00"), "n")]
    compared = scd2.diff(history, spark.createDataFrame(rows, SNAPSHOT), "route_id", TRACKED, D(2025, 2, 1), each_row=True)
    assert sorted((r["route_id"], r["action"]) for r in compared.collect()) == [
        ("A", "unchanged"), ("A", "unchanged"), ("B", "changed"), ("N", "new"), ("N", "new")
    ]
    applied = load(spark, history, rows, D(2025, 2, 1), each_row=True)
    assert sorted(versions(applied, "route_key", "route_id", "base_fare", "version", "is_current")) == [
        (1, "A", fare("1.00"), 1, True), (1, "A", fare("1.00"), 1, True), (2, "B", fare("2.00"), 1, False),
        (3, "B", fare("3.00"), 2, True), (4, "N", fare("8.00"), 1, True), (5, "N", fare("9.00"), 1, True),
    ]


def test_invariants_tell_repeats_from_several_versions(spark):
    start = D(2025, 1, 1)
    rows = [
        (1, "A", fare("1"), "a", start, None, True, 1), (1, "A", fare("1"), "a", start, None, True, 1),
        (2, "B", fare("1"), "b", start, None, True, 1), (3, "B", fare("1"), "b", D(2025, 2, 1), None, True, 2),
        (4, "C", fare("1"), "c", start, D(2025, 2, 1), False, 1),
    ]
    found = scd2.invariants(spark.createDataFrame(rows, HISTORY), "route_id").first().asDict()
    assert found == {"members": 3, "flag_mismatches": 0, "several_current": 1, "gaps": 0, "overlaps": 2}
