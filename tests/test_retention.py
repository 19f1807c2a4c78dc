"""Retention that deletes: folders that have passed go, the cutoff's month is rewritten, the rest is untouched."""

import datetime as dt
from pathlib import Path

from starmart.operators import control

SCHEMA = "id int, at timestamp_ntz"


def written(spark, path, days):
    df = spark.createDataFrame([(k, d and dt.datetime(*d)) for k, d in enumerate(days)], SCHEMA)
    control.write_by_month(df, path, "at")
    return df.schema


def ids(spark, path):
    return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_only_expired_rows_go(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [(2024, 12, 31), (2025, 1, 31, 23, 59), (2025, 2, 9, 23, 59), (2025, 2, 10), (2025, 2, 28), (2025, 3, 1), None]
    schema = written(spark, path, days)
    march = {p: p.stat().st_mtime_ns for p in Path(path, "month_key=202503").iterdir()}
    for deleted in (3, 0):  # a second run finds nothing
        report = control.apply_retention(spark, [("t", path, schema, "at", dt.date(2025, 2, 10))]).collect()
        assert [tuple(r) for r in report] == [("t", deleted, 4)]
        assert ids(spark, path) == [3, 4, 5, 6]
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == ["month_key=202502", "month_key=202503", "month_key=__HIVE_DEFAULT_PARTITION__"]
    assert {p: p.stat().st_mtime_ns for p in Path(path, "month_key=202503").iterdir()} == march


def test_a_month_or_a_table_that_becomes_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = written(spark, path, [(2025, 2, 1), (2025, 2, 3), (2025, 1, 1)])
    report = control.apply_retention(spark, [("t", path, schema, "at", dt.date(2025, 2, 10))]).collect()
    assert [tuple(r) for r in report] == [("t", 3, 0)]
    again = control.apply_retention(spark, [("t", path, schema, "at", dt.date(2025, 2, 10))]).collect()
    assert [tuple(r) for r in again] == [("t", 0, 0)]


def test_a_copy_keeps_rows_and_months_without_an_exchange(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "copy")
    schema = written(spark, path, [(2024, 12, 31), (2025, 1, 31, 23, 59), (2025, 1, 1), None])
    control.copy_by_month(spark, path, copy, schema)
    assert ids(spark, copy) == ids(spark, path) == [0, 1, 2, 3]
    assert sorted(p.name for p in Path(copy).iterdir() if p.is_dir()) == sorted(p.name for p in Path(path).iterdir() if p.is_dir())
    plan = spark.read.parquet(copy)
    assert plan.where("month_key IS NULL").count() == 1 and plan.where("month_key = 202501").count() == 2


def test_rows_already_split_are_written_as_they_lie(spark, tmp_path):
    path, days = str(tmp_path / "t"), [(2025, 1 + k % 3, 1 + k % 28) for k in range(300)]
    df = spark.createDataFrame([(k, dt.datetime(*d)) for k, d in enumerate(days)], SCHEMA)
    control.write_by_month(df.repartitionByRange(4, "at"), path, "at", split=True)
    assert ids(spark, path) == list(range(300))
    files = [len(list(p.glob("*.parquet"))) for p in Path(path).iterdir() if p.is_dir()]
    assert len(files) == 3 and sum(files) <= 6
