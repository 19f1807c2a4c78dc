"""The batch pipeline: source extracts -> staging -> dimensions -> facts -> marts.

Every step is one distributed read and write; nothing passes through the driver
and a failure stops the run.  A load can be run again: staging replaces its own load
day, facts are merged by their key into the days the extract touches (an extract may
hold part of a day), the calendar spans stored facts too, dimensions are written as a new snapshot under the load's stamp,
marts are refreshed as a whole.
A fact's key is its business key (trip_id, transaction_id), so a reload cannot
renumber rows others refer to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import date_from_key, month_key
from starmart.operators import calendar, control, facts, quality, scd1, scd2, surrogate
from starmart.plans import marts
from starmart.session import ensure_utc, stage
from starmart.sources import reference_rows, writers
from starmart.sources.readers import read_or_empty

TRACKED_ROUTE_COLUMNS = ["base_fare", "is_active", "route_name", "transport_type"]


@dataclass(frozen=True)
class Extracts:
    """Source frames in the column names of the staging contract."""

    users: DataFrame
    routes: DataFrame
    stations: DataFrame
    vehicles: DataFrame
    trips: DataFrame
    transactions: DataFrame


def run(
    spark: SparkSession,
    extracts: Extracts,
    out_dir: str,
    as_of: dt.date,
    load_time: dt.datetime,
    previous: str | None = None,
    load_id: int = 0,
    calendar_range: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Load one snapshot and return its row counts.

    ``previous`` is the dimension folder of the load before, absent on the first
    run.  Dimension tables go to ``out_dir/dims/<load stamp>`` so a table is
    never overwritten while it is read.
    """
    ensure_utc(spark)
    dims = f"{out_dir}/dims/{load_time:%Y%m%dT%H%M%S}"

    def saved(df: DataFrame, name: str) -> DataFrame:
        path = f"{dims}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def earlier(name: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(spark, f"{previous or dims + '/none'}/{name}", schema)

    for name, source in vars(extracts).items():
        staged = source.withColumns(
            {
                "load_date": F.lit(load_time).cast("timestamp_ntz"),
                "source_system": F.lit("OLTP"),
                "load_day": F.lit(as_of),
            }
        )
        writers.replace_partitions(staged, f"{out_dir}/staging/stg_{name}", ["load_day"])
    staged = {
        name: spark.read.parquet(f"{out_dir}/staging/stg_{name}")
        .where(F.col("load_day") == F.lit(as_of))
        .drop("load_day", "load_date", "source_system")
        for name in vars(extracts)
    }

    def type_one(rows: DataFrame, name: str, business_key: str, key: str) -> DataFrame:
        schema = T.StructType(
            [
                *rows.schema.fields,
                T.StructField(key, T.LongType()),
                T.StructField("created_date", T.TimestampNTZType()),
                T.StructField("updated_date", T.TimestampNTZType()),
            ]
        )
        return saved(scd1.replace_attributes(earlier(name, schema), rows, business_key, key, load_time), name)

    dim_user = type_one(scd1.user_rows(staged["users"], as_of), "dim_user", "user_id", "user_key")
    dim_station = type_one(scd1.station_rows(staged["stations"]), "dim_station", "station_id", "station_key")
    dim_vehicle = type_one(scd1.vehicle_rows(staged["vehicles"], as_of), "dim_vehicle", "vehicle_id", "vehicle_key")

    routes = scd2.route_rows(staged["routes"])
    route_schema = T.StructType(
        [
            T.StructField("route_key", T.LongType()),
            *routes.schema.fields,
            T.StructField("effective_date", T.DateType()),
            T.StructField("expiration_date", T.DateType()),
            T.StructField("is_current", T.BooleanType()),
            T.StructField("version", T.IntegerType()),
            T.StructField("created_date", T.TimestampNTZType()),
            T.StructField("updated_date", T.TimestampNTZType()),
            T.StructField("source_system", T.StringType()),
        ]
    )
    history = earlier("dim_route", route_schema)
    dim_route = saved(
        scd2.apply_snapshot(history, routes, "route_id", "route_key", TRACKED_ROUTE_COLUMNS, as_of, load_time=load_time),
        "dim_route",
    )
    known_days = earlier("dim_date", T.StructType([T.StructField("date", T.DateType())]))
    stored = [
        (read_or_empty(spark, f"{out_dir}/{name}", T.StructType([T.StructField(k, T.IntegerType()) for k in keys])), keys)
        for name, keys in (("fact_trips", ["start_date_key", "end_date_key"]), ("fact_transactions", ["date_key"]))
    ]
    dim_date = saved(
        calendar.date_dimension(spark, *calendar_range) if calendar_range else _calendar(staged, known_days, stored), "dim_date"
    )
    dim_time = saved(calendar.time_dimension(spark), "dim_time")
    methods = saved(reference_rows.payment_methods(spark), "dim_payment_method")

    trips, payments = staged["trips"], staged["transactions"]
    loaded = stage(
        facts.trip_facts(trips, payments, dim_user, dim_route, dim_vehicle, dim_station, load_time=load_time), "trip-facts"
    )
    good, bad = surrogate.split_unresolved(loaded, ["user_key", "route_key"])
    keep = good.withColumn("month_key", month_key("start_date_key"))
    _merge_days(keep, f"{out_dir}/fact_trips", "start_date_key", "trip_id")
    bad.write.mode("overwrite").parquet(f"{out_dir}/quarantine/{as_of:%Y%m%d}/fact_trips")
    fact_trips = spark.read.schema(keep.schema).parquet(f"{out_dir}/fact_trips")

    keyed = fact_trips.select("trip_id", F.col("trip_id").alias("trip_key"))
    ledger = facts.transaction_facts(payments, dim_user, keyed, methods).withColumn("month_key", month_key("date_key"))
    _merge_days(stage(ledger, "ledger"), f"{out_dir}/fact_transactions", "date_key", "transaction_id")
    fact_transactions = spark.read.schema(ledger.schema).parquet(f"{out_dir}/fact_transactions")

    marts.build_all(fact_trips, dim_user, dim_route, dim_station, dim_date, dim_time, as_of, f"{out_dir}/marts", load_time)

    checks = quality.unique_check(fact_trips, "fact_trips", ["trip_id"]).unionByName(
        quality.foreign_key_check(fact_trips, dim_route, "route_key", "route_key", "fact_trips")
    )
    quality.stamp_results(checks, load_id, load_time).write.mode("overwrite").parquet(f"{out_dir}/quality/{as_of:%Y%m%d}")
    return control.table_counts(
        {
            "dim_user": dim_user,
            "dim_route": dim_route,
            "dim_station": dim_station,
            "dim_vehicle": dim_vehicle,
            "dim_date": dim_date,
            "dim_time": dim_time,
            "fact_trips": fact_trips,
            "fact_transactions": fact_transactions,
        }
    )


def _calendar(staged: dict[str, DataFrame], earlier: DataFrame, stored: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Every day that this extract, a stored fact or the calendar before can name."""
    trips, payments = staged["trips"], staged["transactions"]
    days = [trips.select(F.col(c).cast("date").alias("day")) for c in ("start_time", "end_time")]
    days.append(payments.select(F.col("transaction_date").cast("date").alias("day")))
    days.append(earlier.select(F.col("date").alias("day")))
    for facts_of, keys in stored:
        # Their span only: two rows each, from the key columns.
        ends = facts_of.agg(*[f(F.col(k)).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)])
        days.append(ends.select(F.explode(F.array(*[date_from_key(c) for c in ends.columns])).alias("day")))
    spanned = days[0]
    for more in days[1:]:
        spanned = spanned.unionByName(more)
    return calendar.date_dimension_for(spanned, "day")


def _merge_days(rows: DataFrame, path: str, day: str, key: str) -> None:
    """Merge ``rows`` by ``key`` into a fact stored by day.

    Rewritten are the days of ``rows`` and those where their keys are stored so far: a row
    whose day has changed leaves its old one.  Rows without a day are a day of their own.
    Other rows of these days stay, and so do all other days' files.
    """
    spark = rows.sparkSession
    stored = read_or_empty(spark, path, rows.schema)
    before = stored.select(key, day).join(rows.select(key), key, "left_semi").select(day)
    touched = {r[0] for r in rows.select(day).unionByName(before).distinct().collect()}  # at most the days on record
    if not touched:
        return
    inside = F.col(day).isin([d for d in touched if d is not None])
    if None in touched:
        inside = inside | F.col(day).isNull()
    kept = stored.where(inside).join(rows.select(key), key, "left_anti")
    # Written first: a table is never overwritten while it is read.
    merged = stage(kept.unionByName(rows), "merged-days")
    writers.replace_partitions(merged, path, ["month_key", day], [key])
    for empty in touched - {r[0] for r in merged.select(day).distinct().collect()}:
        writers.delete_folder(spark, f"{path}/{_folder('month_key', empty and empty // 100)}/{_folder(day, empty)}")


def _folder(column: str, value: int | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def log_load(
    spark: SparkSession, log_path: str, load_id: int, source: str, table: str, load_type: str,
    clock: Callable[[], dt.datetime], work: Callable[[], tuple[int, dt.datetime | None]],
) -> None:
    """Run ``work`` between a start and an end record of the control log.

    ``work`` returns the rows it inserted and the watermark it reached, if any.
    A failure is recorded and raised again.
    """
    begun = control.start_record(spark, load_id, source, table, load_type, clock())
    begun.write.mode("append").parquet(log_path)
    try:
        rows, watermark = work()
    except Exception as err:
        control.end_records(begun, "failed", clock(), error=str(err)).write.mode("append").parquet(log_path)
        raise
    control.end_records(begun, "success", clock(), inserted=rows, watermark=watermark).write.mode("append").parquet(log_path)
