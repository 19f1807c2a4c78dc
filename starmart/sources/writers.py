"""Sinks: append/overwrite, partition replacement, sorted layout, name-matched copy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode {mode}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_counted(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> int:
    """Write and return the number of rows written, observed on the way: no second pass."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode, partition_by)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], spread_by: list[str] | None = None) -> None:
    """Overwrite only the partitions present in ``df``; replaying it is harmless.

    ``spread_by`` range-splits the rows on (partition columns, spread columns)
    first: a task then writes few partitions instead of a file into each, and a
    partition holding most rows is still shared by several tasks.

    Partitions stay for long: they are packed with zstd.
    """
    if spread_by:
        df = df.repartitionByRange(*partition_by, *spread_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_sorted(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str]) -> None:
    """Layout of a mart: range-split by partition and sort key, sorted inside files.

    Range splitting on both lets one month that holds most rows spread over many
    tasks, and gives files disjoint key ranges for min/max skipping.
    """
    (
        df.repartitionByRange(*partition_by, *sort_by)
        .sortWithinPartitions(*partition_by, *sort_by)
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def truncate(path: str, schema: T.StructType, spark: SparkSession) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def copy_common(
    source: DataFrame,
    target: T.StructType,
    load_date: dt.datetime,
    source_system: str,
    exclude: tuple[str, ...] = ("load_date", "source_system"),
) -> DataFrame:
    """Columns both sides share, in source order, cast to the target types and stamped."""
    types = {f.name: f.dataType for f in target.fields if f.name not in exclude}
    shared = [F.col(c).cast(types[c]).alias(c) for c in source.columns if c in types]
    return source.select(
        *shared,
        F.lit(load_date).cast("timestamp_ntz").alias("load_date"),
        F.lit(source_system).alias("source_system"),
    )


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, whatever file system it is on; none if there is no such path."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)
