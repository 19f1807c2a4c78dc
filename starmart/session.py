"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on.  Cluster sizing (executors, memory, shuffle
# partitions) belongs to the submitter and is left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "starmart", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> None:
    """Epoch arithmetic and streaming windows are defined on UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, bench) may fall back to a folder of its
    own; on a cluster a missing setting is an error, never a machine-local path.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starmart-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path; all paths of an application share one folder, so they can be dropped together."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_bucket_values: dict[tuple[str, int], list[int]] = {}


def _values_by_bucket(spark: SparkSession, buckets: int) -> list[int]:
    """For each bucket a number that Spark's bucket hash sends there."""
    known = (spark.sparkContext.applicationId, buckets)
    if known not in _bucket_values:
        found: dict[int, int] = {}
        reach = 16 * buckets
        while len(found) < buckets:
            bucket = F.pmod(F.hash(F.col("id")), F.lit(buckets))
            rows = spark.range(reach, numPartitions=1).groupBy(bucket.alias("b")).agg(F.min("id").alias("v")).collect()
            found, reach = {r["b"]: r["v"] for r in rows}, 4 * reach
        _bucket_values[known] = [found[b] for b in range(buckets)]
    return _bucket_values[known]


MAX_BUCKETS = 100_000  # Spark's own limit


def _buckets(spark: SparkSession) -> int:
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)


def stage_in_buckets(df: DataFrame, number: str, bucket: str, label: str) -> DataFrame:
    """As ``stage``, with a column ``bucket`` by which the files are bucketed: one for each value of ``number``
    (0, 1 .. below the shuffle partitions), so groups and windows within it need no further exchange.
    """
    spark = df.sparkSession
    values = F.split(F.lit(",".join(map(str, _values_by_bucket(spark, _buckets(spark))))), ",").cast("array<bigint>")
    return stage_by(df.withColumn(bucket, F.element_at(values, (F.col(number) % _buckets(spark) + 1).cast("int"))), bucket, label)


def stage_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """As ``stage``, in buckets by ``column``, as many as shuffle partitions: joins and groups by it leave the rows where they are."""
    spark = df.sparkSession
    path, name = new_path(spark, label), f"staged_{uuid.uuid4().hex}"
    # The catalog entry only serves to read the bucket layout; the files are the table.
    df.write.bucketBy(_buckets(spark), column).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return staged


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result must not be recomputed differently (range boundaries,
    row ids): a lost executor re-reads the files.  Parquet keeps column pruning,
    which a checkpointed row set would lose.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
