"""Load control, watermarks, retention, row-count reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import seconds_between
from starmart.operators.merge import latest_per_key
from starmart.session import stage
from starmart.sources.writers import delete_folder, list_folders, replace_partitions

MONTH = "month_key"
FIRST_WATERMARK = dt.datetime(1900, 1, 1)
STAGING_RETENTION_DAYS = 7
STREAM_RETENTION_DAYS = 3
POSITION_RETENTION_DAYS = 90
TRIP_RETENTION_YEARS = 3
TRANSACTION_RETENTION_YEARS = 7

LOAD_COLUMNS = (
    "load_id bigint, source_system string, table_name string, load_type string, load_start_time timestamp_ntz, "
    "load_end_time timestamp_ntz, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, status string, "
    "error_message string, watermark_value timestamp_ntz"
)


def start_record(spark: SparkSession, load_id: int, source: str, table: str, load_type: str, at: dt.datetime) -> DataFrame:
    """The control log is append-only: a start record now, an end record later."""
    row = (load_id, source, table, load_type, at, None, None, None, None, "running", None, None)
    return spark.createDataFrame([row], LOAD_COLUMNS)


def end_records(
    started: DataFrame,
    status: str,
    at: dt.datetime,
    inserted: int = 0,
    updated: int = 0,
    deleted: int = 0,
    watermark: dt.datetime | None = None,
    error: str | None = None,
) -> DataFrame:
    values = {
        "load_end_time": at,
        "status": status,
        "rows_inserted": inserted,
        "rows_updated": updated,
        "rows_deleted": deleted,
        "watermark_value": watermark,
        "error_message": error,
    }
    types = {f.name: f.dataType for f in started.schema.fields}
    return started.withColumns({c: F.lit(v).cast(types[c]) for c, v in values.items()})


def load_state(records: DataFrame) -> DataFrame:
    """Latest record per load: an end record outranks its start record."""
    return latest_per_key(records, ["load_id"], [F.coalesce("load_end_time", "load_start_time"), F.col("status") != "running"])


def last_watermarks(loads: DataFrame) -> DataFrame:
    """Last known watermark per (source_system, table_name) of successful loads.

    A successful load that recorded no watermark does not reset it.
    """
    usable = (F.col("status") == "success") & F.col("watermark_value").isNotNull()
    latest = F.max_by("watermark_value", F.when(usable, F.struct("load_end_time", "load_id")))
    return loads.groupBy("source_system", "table_name").agg(
        F.coalesce(latest, F.lit(FIRST_WATERMARK).cast("timestamp_ntz")).alias("watermark")
    )


def last_watermark(loads: DataFrame, source: str, table: str) -> dt.datetime:
    row = last_watermarks(
        loads.where((F.col("source_system") == source) & (F.col("table_name") == table))
    ).first()
    return row["watermark"] if row else FIRST_WATERMARK


def extract_newer(df: DataFrame, column: str, watermark: dt.datetime) -> DataFrame:
    """Rows past the watermark; a plain comparison, so it is pushed to the scan."""
    return df.where(F.col(column) > F.lit(watermark).cast(df.schema[column].dataType))


def next_watermark(extracted: DataFrame, column: str, watermark: dt.datetime) -> dt.datetime:
    return extracted.agg(F.max(column).alias("w")).first()["w"] or watermark


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def years_before(as_of: dt.date, years: int) -> dt.date:
    # 29 February has no counterpart in most years; the day before does.
    day = 28 if (as_of.month, as_of.day) == (2, 29) else as_of.day
    return as_of.replace(year=as_of.year - years, day=day)


def expired(df: DataFrame, load_date: str, cutoff: dt.date) -> Column:
    """Rows dated before the cutoff, a plain comparison with the column's own type; rows without a date are kept."""
    return F.coalesce(F.col(load_date) < F.lit(cutoff).cast(df.schema[load_date].dataType), F.lit(False))


def retention_reports(tables: list[tuple[str, DataFrame, str, dt.date]]) -> DataFrame:
    """Rows to delete and to keep per (table, frame, date column, cutoff), counted before anything is removed."""
    return _union(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count_if(expired(df, c, cutoff)).alias("rows_deleted"),
                F.count_if(~expired(df, c, cutoff)).alias("rows_kept"),
            )
            for name, df, c, cutoff in tables
        ]
    )


def drop_expired_partitions(spark: SparkSession, table: str, column: str, cutoff: dt.date) -> DataFrame:
    """Retention of a catalog table partitioned by ``column`` (a load day): whole
    partitions are dropped, no file is rewritten.  Returns the rows deleted per day.
    """
    old = spark.table(table).where(F.col(column) < F.lit(cutoff)).groupBy(column).count()
    days = old.collect()  # one row per expired day
    for day in days:
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({column} = DATE'{day[column]}')")
    return spark.createDataFrame(
        [(table, d[column], d["count"]) for d in days], f"table_name string, {column} date, rows_deleted bigint"
    )


def write_by_month(df: DataFrame, path: str, column: str, split: bool = False) -> None:
    """A table in monthly folders of ``column``, so that retention drops folders instead of rewriting files.

    ``split`` says that the rows are range-split by time already, so they are written as they lie.
    """
    month = (F.year(column) * 100 + F.month(column)).cast("int")
    replace_partitions(df.withColumn(MONTH, month), path, [MONTH], None if split else [column])


def copy_by_month(spark: SparkSession, source: str, path: str, schema: T.StructType) -> None:
    """A copy of a table written by month: its files hold a month each, so no row moves to another task."""
    months = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])
    replace_partitions(spark.read.schema(months).parquet(source), path, [MONTH])


def delete_expired(spark: SparkSession, path: str, schema: T.StructType, column: str, cutoff: dt.date) -> None:
    """Delete the rows dated before ``cutoff`` from a table written by month.

    Months that have passed are dropped as folders; only the cutoff's own month is written
    again, without its expired rows.  Rows without a date have a folder of their own and stay.
    A second run finds nothing to do.
    """
    border = cutoff.year * 100 + cutoff.month
    for folder in list_folders(spark, path):
        month = folder.partition("=")[2]
        if month.isdigit() and int(month) < border:
            delete_folder(spark, f"{path}/{folder}")
        elif month == str(border):
            rows = spark.read.schema(schema).parquet(f"{path}/{folder}")
            kept = stage(rows.where(~expired(rows, column, cutoff)), "retained")
            if kept.isEmpty():
                delete_folder(spark, f"{path}/{folder}")
            else:
                replace_partitions(kept.withColumn(MONTH, F.lit(border)), path, [MONTH], [column])


def apply_retention(spark: SparkSession, tables: list[tuple[str, str, T.StructType, str, dt.date]]) -> DataFrame:
    """Delete from each (name, path, schema, date column, cutoff); rows deleted, and kept as they are read back."""

    def counted(name: str, path: str, sign: int) -> DataFrame:
        rows = spark.read.parquet(path) if list_folders(spark, path) else spark.range(0)
        return rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.lit(sign).alias("sign"))

    before = stage(_union([counted(name, path, 1) for name, path, _, _, _ in tables]), "before-retention")
    for _, path, schema, column, cutoff in tables:
        delete_expired(spark, path, schema, column, cutoff)
    both = before.unionByName(_union([counted(name, path, -1) for name, path, _, _, _ in tables]))
    return both.groupBy("table_name").agg(
        F.sum(F.col("n") * F.col("sign")).alias("rows_deleted"), F.sum(F.when(F.col("sign") < 0, F.col("n"))).alias("rows_kept")
    )


def recent_loads(loads: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
    minutes = seconds_between("load_start_time", "load_end_time") / 60
    return loads.where(F.col("load_start_time") > since).withColumn("duration_minutes", minutes).orderBy(
        F.col("load_start_time").desc_nulls_first(), "load_id"
    )


def staging_statistics(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Count, oldest and latest load per table: name -> (frame, load date column)."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.min(c).cast("timestamp_ntz").alias("oldest_load"),
            F.max(c).cast("timestamp_ntz").alias("latest_load"),
        )
        for name, (df, c) in tables.items()
    ]
    return _union(parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """All counts in one job."""
    return _union(
        [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
