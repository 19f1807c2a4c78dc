"""Block-wise ordered computations give what ordinary windows give, also with one hot key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    """5 000 rows, a third of them under key 0, some under NULL; every seventh value missing."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 != 1, F.col("id") % 40)
    value = F.when(F.col("id") % 7 != 0, (F.col("id") * 7919 % 101).cast("decimal(10,2)"))
    return spark.range(5000, numPartitions=7).select(
        "id", key.alias("k"), ((F.col("id") * 7907) % 5003).alias("t"), value.alias("v")
    )


@pytest.fixture(autouse=True)
def many_blocks(spark):
    """Keep small blocks apart, so borders fall inside keys."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def same(left, right):
    columns = sorted(left.columns)
    assert sorted(map(tuple, left.select(columns).collect()), key=str) == sorted(
        map(tuple, right.select(columns).collect()), key=str
    )


def test_number_rows(rows):
    out = ordered.number_rows(rows, [F.col("t").desc()], "rn", total="n")
    expected = rows.withColumn("rn", F.row_number().over(Window.orderBy(F.col("t").desc()))).withColumn("n", F.lit(5000))
    same(out, expected)


def test_blocks_cut_a_hot_key(rows):
    blocks = ordered._blocks(rows, [F.col("k"), F.col("t")])
    assert blocks.where("k = 0").select("_block").distinct().count() > 1


@pytest.mark.parametrize("buckets", [1, 5, 7])
@pytest.mark.parametrize("n", [1, 3, 5, 23, 1500])
def test_ntile(spark, n, buckets):
    numbered = spark.range(n).withColumn("rn", F.col("id") + 1).withColumn("n", F.lit(n))
    out = numbered.select("rn", ordered.ntile(F.col("rn"), F.col("n"), buckets).alias("b"))
    same(out, numbered.select("rn", F.ntile(buckets).over(Window.orderBy("rn")).alias("b")))


def test_running_sums(rows):
    out = ordered.running_sums(rows, ["k"], [F.col("t")], {"s": F.col("v"), "c": F.lit(1).cast("long")})
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    same(out, rows.withColumn("s", F.sum("v").over(w)).withColumn("c", F.sum(F.lit(1).cast("long")).over(w)))


def test_previous_row(rows):
    out = ordered.previous_row(rows, ["k"], [F.col("t")], {"pt": "t", "pv": "v"})
    w = Window.partitionBy("k").orderBy("t")
    same(out, rows.withColumn("pt", F.lag("t").over(w)).withColumn("pv", F.lag("v").over(w)))


def test_rank_within(rows):
    out = ordered.rank_within(rows, ["k"], [F.col("t").desc()], "r")
    same(out, rows.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.col("t").desc()))))


def test_empty_input(rows):
    none = rows.where("id < 0")
    assert ordered.number_rows(none, [F.col("t")], "rn").count() == 0
    assert ordered.running_sums(none, ["k"], [F.col("t")], {"s": F.col("v")}).count() == 0
