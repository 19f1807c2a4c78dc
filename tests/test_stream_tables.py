"""Tables kept by streams: parts that merge, buckets that are rewritten, replays and new checkpoints."""

import datetime as dt
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.parts import Measures, distinct_count
from starmart.streaming import tables

ROWS = "route string, date date, user long, fare decimal(10,2)"
MEASURES = Measures(
    ("route", "date"), {"trips": "count(1)", "revenue": "sum(fare)", "priced": "count(fare)"}, {"users": "user"}
)


def made_up(rng, size):
    return [
        (rng.choice(["R1", "R1", "R1", "R2", None]), rng.choice([None, *[dt.date(2025, 1, 30) + dt.timedelta(days=k) for k in range(5)]]),
         rng.choice([None, *range(300)]), rng.choice([None, 1, 2.5]))
        for _ in range(size)
    ]


def plain(rows):
    out = defaultdict(lambda: [0, 0.0, 0, set()])
    for route, date, user, fare in rows:
        row = out[route, date]
        row[0] += 1
        row[1] += fare or 0
        row[2] += fare is not None
        row[3] |= {user} - {None}
    return {k: (n, money if priced else None, priced, len(users)) for k, (n, money, priced, users) in out.items()}


def folded(mart, spark):
    rows = mart.read(spark).withColumn("users", distinct_count("users")).collect()
    return {(r.route, r.date): (r.trips, None if r.revenue is None else float(r.revenue), r.priced, r.users) for r in rows}


def frame(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:3], None if r[3] is None else Decimal(str(r[3]))) for r in rows], ROWS)


@pytest.fixture
def mart(spark, tmp_path):
    schema = MEASURES.partial(frame(spark, [])).schema
    return tables.DeltaMart(str(tmp_path / "mart"), schema, MEASURES, fold_every=3)


def files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_parts_equal_one_pass(spark, mart):
    rng, rows = random.Random(1), []
    handle = mart.handler(lambda batch: batch, "first")
    for n in range(8):
        batch = made_up(rng, 120)
        rows += batch
        handle(frame(spark, batch), n)
        if n in (2, 5):
            handle(frame(spark, batch), n)  # replayed after it was folded in
        if n == 6:
            handle(frame(spark, batch), n)  # replayed while still a delta
        assert folded(mart, spark) == plain(rows)
    # A new checkpoint counts from 0 again and adds to what is there.
    late = [("R1", dt.date(2025, 1, 30), 999, 1.0)]
    mart.handler(lambda batch: batch, "second")(frame(spark, late), 0)
    assert folded(mart, spark) == plain(rows + late)


def test_files_stay_bounded_and_untouched_months_are_kept(spark, mart):
    handle = mart.handler(lambda batch: batch, "run")
    january, february = [("R1", dt.date(2025, 1, 5), 1, 1.0)], [("R1", dt.date(2025, 2, 5), 1, 1.0)]
    for n in range(3):
        handle(frame(spark, january).coalesce(1), n)
    kept = [p for p in files(mart.path) if "month=202501" in str(p)]
    for n in range(3, 30):
        handle(frame(spark, february).coalesce(1), n)
    assert [p for p in files(mart.path) if "month=202501" in str(p)] == kept  # never written again
    february_files = [p for p in files(mart.path) if "month=202502" in str(p)]
    assert len(february_files) <= 8 * tables.KEEP_COMMITS
    assert len([p for p in files(mart.path) if "/deltas/" in str(p)]) <= 3 * (tables.KEEP_COMMITS + 1)
    assert len(list(Path(mart.path, "commits").iterdir())) <= 2 * tables.KEEP_COMMITS
    assert folded(mart, spark)["R1", dt.date(2025, 2, 5)][0] == 27


def test_a_crash_before_the_commit_leaves_the_old_state(spark, mart, monkeypatch):
    handle = mart.handler(lambda batch: batch, "run")
    rows = made_up(random.Random(2), 50)
    for n in range(2):
        handle(frame(spark, rows), n)

    def fail(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(tables.CommitLog, "publish", fail)
        with pytest.raises(RuntimeError):
            handle(frame(spark, rows), 2)
    assert folded(mart, spark) == plain(rows * 3)  # the third delta is there, only not folded
    handle(frame(spark, rows), 2)
    assert folded(mart, spark) == plain(rows * 3)


def test_sketches_merge_within_their_error(spark):
    big = Measures(("part",), {}, {"users": "id"})
    rows = spark.range(60_000).withColumn("part", F.lit(1)).unionByName(spark.range(30_000, 90_000).withColumn("part", F.lit(2)))
    parts = big.partial(rows).drop("part").withColumn("part", F.lit(0))
    merged = big.merge(parts).withColumn("users", distinct_count("users")).first()["users"]
    assert abs(merged - 90_000) < 4 * 0.016 * 90_000


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.IntegerType()), T.StructField("x", T.StringType())])


def test_latest_rows_over_replays_and_new_checkpoints(spark, tmp_path):
    table = tables.LatestTable(str(tmp_path / "kv"), SCHEMA, ["k"], ["v"], buckets=8)
    rng, best = random.Random(3), {}
    for run, n in [("a", 0), ("a", 1), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 0)]:
        rng = random.Random(f"{run}{n}")
        rows = [(rng.randint(0, 60), rng.randint(0, 1000), f"{run}{n}") for _ in range(40)]
        for k, v, x in rows:
            best[k] = max(best.get(k, (-1, "")), (v, x))
        table.handler(run)(spark.createDataFrame(rows, SCHEMA), n)
        assert {r.k: (r.v, r.x) for r in table.read(spark).collect()} == best


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = tables.LatestTable(str(tmp_path / "kv"), SCHEMA, ["k"], ["v"], buckets=16)
    table.handler("run")(spark.range(200).selectExpr("id AS k", "1 AS v", "'old' AS x"), 0)
    before = {p for p in files(table.path) if "/base/" in str(p)}
    table.handler("run")(spark.createDataFrame([(5, 2, "new")], SCHEMA), 1)
    table.handler("run")(spark.createDataFrame([], SCHEMA), 2)  # nothing new: a commit, no files
    after = {p for p in files(table.path) if "/base/" in str(p)}
    assert len(after - before) == 1 and len(before - after) <= 8
    assert {r.x for r in table.read(spark).where("k = 5").collect()} == {"new"} and table.read(spark).count() == 200


def test_the_first_batch_fixes_the_buckets(spark, tmp_path):
    path = str(tmp_path / "kv")
    tables.LatestTable(path, SCHEMA, ["k"], ["v"], buckets=4).handler("a")(spark.createDataFrame([(1, 1, "x")], SCHEMA), 0)
    later = tables.LatestTable(path, SCHEMA, ["k"], ["v"], buckets=9)
    later.handler("b")(spark.createDataFrame([(1, 2, "y"), (2, 1, "z")], SCHEMA), 0)
    assert sorted(map(tuple, later.read(spark).collect())) == [(1, 2, "y"), (2, 1, "z")]
