"""Tables that a stream keeps up to date, batch by batch.

Both kinds write new files beside the old ones and then publish them with one small commit,
so readers see whole states only and a crash leaves nothing but files that nobody refers to.
A commit names the last batch of every run (a checkpoint's life), so a replayed batch is known
and a new checkpoint goes on where the table stands.  Files that neither the newest commit nor
the one before refers to are removed.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.merge import latest_per_key
from starmart.operators.parts import Measures
from starmart.sources.writers import delete_folder, list_folders

KEEP_COMMITS = 2


class CommitLog:
    """States of a table: each commit is one file with (name, value) rows, all of them valid together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def numbers(self) -> list[int]:
        return sorted(int(f.partition("=")[2]) for f in list_folders(self.spark, self.path))

    def state(self, number: int) -> dict[str, int]:
        rows = self.spark.read.schema("name string, value long").parquet(f"{self.path}/commit={number}").collect()
        return {r["name"]: r["value"] for r in rows}

    def latest(self) -> tuple[int, dict[str, int]]:
        numbers = self.numbers()
        return (numbers[-1], self.state(numbers[-1])) if numbers else (-1, {})

    def publish(self, number: int, state: dict[str, int]) -> None:
        rows = self.spark.createDataFrame(sorted(state.items()), "name string, value long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commit={number}")

    def forget(self) -> list[dict[str, int]]:
        """Drop all but the newest commits; their states."""
        numbers = self.numbers()
        for old in numbers[:-KEEP_COMMITS]:
            delete_folder(self.spark, f"{self.path}/commit={old}")
        return [self.state(n) for n in numbers[-KEEP_COMMITS:]]


def _of(state: dict[str, int], kind: str) -> dict[str, int]:
    return {name.partition(":")[2]: value for name, value in state.items() if name.startswith(f"{kind}:")}


class _Slices:
    """A table in slices (months, buckets), each of which some commit wrote as a whole."""

    def __init__(self, path: str, slice_column: str, schema: T.StructType):
        self.path, self.column, self.schema = path, slice_column, schema

    def read(self, spark: SparkSession, state: dict[str, int], only: set[str] | None = None) -> DataFrame:
        held = _of(state, self.column)
        paths = [f"{self.path}/base/commit={c}/{self.column}={s}" for s, c in held.items() if only is None or s in only]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, number: int, spread_by: list[str]) -> None:
        spread = rows.repartitionByRange(self.column, *spread_by)
        spread.write.mode("overwrite").partitionBy(self.column).parquet(f"{self.path}/base/commit={number}")

    def clean(self, spark: SparkSession, states: list[dict[str, int]]) -> None:
        """Remove slices that none of the states refers to."""
        used = {(s, c) for state in states for s, c in _of(state, self.column).items()}
        for commit in list_folders(spark, f"{self.path}/base"):
            folder, number = f"{self.path}/base/{commit}", int(commit.partition("=")[2])
            slices = list_folders(spark, folder)
            gone = [s for s in slices if (s.partition("=")[2], number) not in used]
            for name in gone:
                delete_folder(spark, f"{folder}/{name}")
            if len(gone) == len(slices):
                delete_folder(spark, folder)


class DeltaMart:
    """A mart of mergeable parts: a batch adds its own parts, and now and then they are folded in.

    A late row costs one row of a delta, not its day: facts are never read again.  After
    ``fold_every`` batches the deltas are merged with the months they touch; other months'
    files stay as they are.  So a reader merges at most ``fold_every`` deltas, and a month has
    the files of one write.
    """

    def __init__(self, path: str, parts: T.StructType, measures: Measures, date: str = "date", fold_every: int = 8):
        self.path, self.parts, self.measures, self.date, self.fold_every = path, parts, measures, date, fold_every
        self.slices = _Slices(path, "month", parts)

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/commits")

    def _month(self) -> Column:
        return F.coalesce(F.year(self.date) * 100 + F.month(self.date), F.lit(0))

    def _pending(self, spark: SparkSession, state: dict[str, int]) -> dict[str, list[int]]:
        """Batches of each run that are not folded in."""
        folded = _of(state, "run")
        out = {}
        for run in list_folders(spark, f"{self.path}/deltas"):
            batches = [int(b.partition("=")[2]) for b in list_folders(spark, f"{self.path}/deltas/{run}")]
            name = run.partition("=")[2]
            out[name] = sorted(b for b in batches if b > folded.get(name, -1))
        return {run: batches for run, batches in out.items() if batches}

    def _deltas(self, spark: SparkSession, pending: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.path}/deltas/run={run}/batch={b}" for run, batches in pending.items() for b in batches]
        return spark.read.schema(self.parts).parquet(*paths) if paths else spark.createDataFrame([], self.parts)

    def handler(self, build: Callable[[DataFrame], DataFrame], run: str) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``; ``build`` makes a batch's rows ready to be measured."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            _, state = self._log(spark).latest()
            if batch_id <= state.get(f"run:{run}", -1):
                return  # replayed, and already folded in
            delta = self.measures.partial(build(batch))
            delta.write.mode("overwrite").parquet(f"{self.path}/deltas/run={run}/batch={batch_id}")
            if sum(map(len, self._pending(spark, state).values())) >= self.fold_every:
                self.fold(spark)

        return handle

    def fold(self, spark: SparkSession) -> None:
        log = self._log(spark)
        number, state = log.latest()
        pending = self._pending(spark, state)
        if not pending:
            return
        deltas = self._deltas(spark, pending)
        months = {str(r[0]) for r in deltas.select(self._month()).distinct().collect()}  # at most the months on record
        merged = self.measures.merge(self.slices.read(spark, state, months).unionByName(deltas))
        self.slices.write(merged.withColumn("month", self._month()), number + 1, list(self.measures.keys))
        log.publish(
            number + 1,
            {**state, **{f"month:{m}": number + 1 for m in months}, **{f"run:{r}": max(b) for r, b in pending.items()}},
        )
        states = log.forget()
        self.slices.clean(spark, states)
        folded = _of(states[0], "run") if len(states) == KEEP_COMMITS else {}
        for run, last in folded.items():  # deltas that a reader of the commit before still needs stay
            for name in list_folders(spark, f"{self.path}/deltas/run={run}"):
                if int(name.partition("=")[2]) <= last:
                    delete_folder(spark, f"{self.path}/deltas/run={run}/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All parts, merged."""
        _, state = self._log(spark).latest()
        deltas = self._deltas(spark, self._pending(spark, state))
        return self.measures.merge(self.slices.read(spark, state).unionByName(deltas))


class LatestTable:
    """The latest row per key, in hash buckets: a batch rewrites only the buckets of its keys."""

    def __init__(self, path: str, schema: T.StructType, keys: list[str], version: list[str], buckets: int = 64):
        self.path, self.schema, self.keys, self.version, self.buckets = path, schema, keys, version, buckets
        self.slices = _Slices(path, "bucket", schema)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, [F.col(c) for c in self.version])

    def handler(self, run: str) -> Callable[[DataFrame, int], None]:
        def handle(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            log = CommitLog(spark, f"{self.path}/commits")
            number, state = log.latest()
            if batch_id <= state.get(f"run:{run}", -1):
                return
            # The first batch fixes the number of buckets for good.
            buckets = state.get("buckets", self.buckets)
            bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")
            news = self._latest(batch.select(*self.schema.fieldNames())).persist()
            try:
                touched = {str(r[0]) for r in news.select(bucket).distinct().collect()}  # at most ``buckets``
                if touched:
                    merged = self._latest(self.slices.read(spark, state, touched).unionByName(news))
                    self.slices.write(merged.withColumn("bucket", bucket), number + 1, self.keys)
            finally:
                news.unpersist()
            held = {f"bucket:{b}": number + 1 for b in touched}
            log.publish(number + 1, {**state, **held, "buckets": buckets, f"run:{run}": batch_id})
            self.slices.clean(spark, log.forget())

        return handle

    def read(self, spark: SparkSession) -> DataFrame:
        return self.slices.read(spark, CommitLog(spark, f"{self.path}/commits").latest()[1])
