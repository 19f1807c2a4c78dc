"""Scans: parquet, CSV, JDBC, missing tables, event streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Lazy scan; no eager count, so filters and pruning reach the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan: a table split over a column, or a pushed-down query."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if query is not None:
        if partition_column is None:
            return {**options, "query": query}
        # A partitioned scan needs dbtable; a derived table carries the query.
        table = f"({query}) q"
    options["dbtable"] = table
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs lower and upper bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """First run: a missing path is an empty table.  Every other error propagates."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, max_files: int, fmt: str = "parquet", **options
) -> DataFrame:
    """A stream over the files of a folder; a micro-batch takes at most ``max_files`` of them."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(folder)


def stream_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int, **options) -> DataFrame:
    """Keyed records of a topic with the staging columns of the event contract; a micro-batch takes at most ``max_offsets``.

    Needs the Kafka connector on the class path of the cluster.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .options(**options)
        .load()
    )
    return raw.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )
