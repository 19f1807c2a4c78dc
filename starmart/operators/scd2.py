"""Type-2 dimension: detect, apply, rebuild, look up, audit.

Validity is half-open: [effective_date, expiration_date), open-ended when current.
Windows below run over the versions of one member.  A member has at most one
version per day (a second change on a day amends it), so a group is bounded by
the number of days on record.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.scd1 import SOURCE_SYSTEM, label
from starmart.operators.surrogate import assign_keys, fill_missing_keys
from starmart.sources.reference_rows import TRANSPORT_TYPE_NAMES

# Labels of the tariff history report.
STATUS_CURRENT, STATUS_PAST = "Текущая", "Историческая"

# A month of daily versions: what a row may meet in a point-in-time lookup.
FEW_VERSIONS = 31

VALIDITY = ["effective_date", "expiration_date", "is_current", "version"]
STAMPS = ["created_date", "updated_date", "source_system"]


def route_rows(routes: DataFrame) -> DataFrame:
    """Route snapshot in the dimension's shape: with the transport type's name, after the type."""
    named = label(F.col("transport_type"), TRANSPORT_TYPE_NAMES).alias("transport_type_name")
    return routes.select(*[c for name in routes.columns for c in ([name, named] if name == "transport_type" else [name])])


def _stamp(load_time: dt.datetime | None) -> Column:
    return F.lit(load_time).cast("timestamp_ntz")


def _one_per_key(snapshot: DataFrame, key: str) -> DataFrame:
    """A snapshot may repeat a key; the greatest row wins, whatever the input order."""
    rest = [c for c in snapshot.columns if c != key]
    best = snapshot.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in rest])


def _differs(left: Column, right: Column, tracked: list[str]) -> Column:
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~left[c].eqNullSafe(right[c])
    return changed


def initial_load(
    snapshot: DataFrame, key: str, surrogate_key: str, as_of: dt.date, load_time: dt.datetime | None = None
) -> DataFrame:
    """First versions; with ``load_time`` they carry the load's stamps."""
    rows = _one_per_key(snapshot, key).withColumns(
        {
            "effective_date": F.lit(as_of),
            "expiration_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
            "version": F.lit(1),
        }
    )
    if load_time:
        rows = rows.withColumns(dict(zip(STAMPS, (_stamp(load_time), _stamp(load_time), F.lit(SOURCE_SYSTEM)))))
    return assign_keys(rows, surrogate_key, [key])


def _compare(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of: dt.date, each_row: bool = False
) -> DataFrame:
    current = history.where("is_current")
    attributes = [c for c in snapshot.columns if c != key]
    old = current.select(key, F.struct(*[c for c in current.columns if c != key]).alias("old"))
    rows = snapshot if each_row else _one_per_key(snapshot, key)
    new = rows.select(key, F.struct(*attributes).alias("new"))
    joined = old.join(new, key, "full_outer")
    changed = _differs(F.col("old"), F.col("new"), tracked)
    action = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "vanished")
        .when(~changed, "unchanged")
        .when(F.col("old.effective_date") == F.lit(as_of), "amended")
        .otherwise("changed")
    )
    return joined.withColumn("action", action)


def diff(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of: dt.date, each_row: bool = False
) -> DataFrame:
    """What a load would do to each member: new, changed, amended, unchanged, vanished.

    Of a key that the snapshot repeats the greatest row counts; with ``each_row`` every one does.
    """
    return _compare(history, snapshot, key, tracked, as_of, each_row)


def apply_snapshot(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    surrogate_key: str,
    tracked: list[str],
    as_of: dt.date,
    close_missing: bool = False,
    load_time: dt.datetime | None = None,
    each_row: bool = False,
) -> DataFrame:
    """The history after loading a snapshot.

    With ``each_row`` every row of a key that the snapshot repeats is compared and applied
    for itself, so a repeat shows in the history (see :func:`invariants`).

    A history with ``STAMPS`` keeps them: new versions are stamped with ``load_time``, versions
    that this load changes get it as their ``updated_date``.

    Each compared member yields its resulting rows in one pass (two when it
    changed: the expired version and its successor), so the join runs once.
    Untracked attributes are replaced in place.
    """
    compared = _compare(history, snapshot, key, tracked, as_of, each_row)
    attributes = [c for c in history.columns if c not in [key, surrogate_key, *VALIDITY]]
    known = [c for c in attributes if c in snapshot.columns]
    types = {f.name: f.dataType for f in history.schema.fields}
    today, old, new = F.lit(as_of), F.col("old"), F.col("new")

    def row(surrogate, source, start, end, current, version, touched=F.lit(True)) -> Column:
        values = {surrogate_key: surrogate, "effective_date": start, "expiration_date": end}
        values |= {"is_current": current, "version": version}
        for c in attributes:
            values[c] = (new if source == "new" else old)[c] if c in known else old[c]
        if load_time and set(STAMPS) <= set(attributes):
            values["updated_date"] = F.when(touched, _stamp(load_time)).otherwise(old["updated_date"])
            if start is today:
                values |= {"created_date": _stamp(load_time), "source_system": F.lit(SOURCE_SYSTEM)}
        return F.struct(*[v.cast(types[c]).alias(c) for c, v in values.items()])

    null, true = F.lit(None), F.lit(True)
    fresh = row(null, "new", today, null, true, F.coalesce(old["version"], F.lit(0)) + 1)
    amended = F.col("action") == "amended"
    in_place = row(old[surrogate_key], "new", old["effective_date"], null, true, old["version"], amended)
    expired = row(old[surrogate_key], "old", old["effective_date"], today, F.lit(False), old["version"])
    kept = row(old[surrogate_key], "old", old["effective_date"], null, true, old["version"], F.lit(False))
    action = F.col("action")
    rows = (
        F.when(action == "new", F.array(fresh))
        .when(action == "changed", F.array(expired, fresh))
        .when(action.isin("amended", "unchanged"), F.array(in_place))
        .otherwise(F.array(expired if close_missing else kept))
    )
    result = compared.select(key, F.inline(rows)).select(*history.columns)
    past = history.where(~F.col("is_current"))
    # Repeated rows of a key are numbered in the order of their attributes, so a re-run numbers them alike.
    return fill_missing_keys(past.unionByName(result), surrogate_key, [key, *(known if each_row else [])])


def history_from_feed(feed: DataFrame, key: str, value: str, change_date: str) -> DataFrame:
    """Versions from an ordered change feed with one row per key and day; repeats are dropped."""
    by_day = Window.partitionBy(key).orderBy(change_date)
    is_change = (F.row_number().over(by_day) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(by_day))
    changes = feed.withColumn("_keep", is_change).where("_keep")
    end = F.lead(change_date).over(by_day)
    return changes.select(
        key,
        value,
        F.col(change_date).alias("effective_date"),
        end.alias("expiration_date"),
        end.isNull().alias("is_current"),
        F.row_number().over(by_day).alias("version"),
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def _by_month(history: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, dt.date | None]:
    """Versions once for each month in which they are valid, and the first day of the last such month.

    After the last month in which anything begins or ends, validity no longer changes: that
    month stands for all later ones, so an open version has an end here too.
    """
    start, end = F.col("effective_date"), F.col("expiration_date")
    last = history.agg(F.max(F.greatest(start, end))).first()[0]
    if last is None:
        return history.sparkSession.createDataFrame([], _month_schema(history, key, columns)), None
    tail = last.replace(day=1)
    months = F.sequence(
        F.trunc(start, "month"), F.least(F.trunc(F.coalesce(F.date_sub(end, 1), F.lit(tail)), "month"), F.lit(tail)), F.expr("INTERVAL 1 MONTH")
    )
    valid = history.where(start.isNotNull() & (end.isNull() | (end > start)))
    return valid.select(
        F.col(key).alias("_id"), F.explode(months).alias("_month"), start.alias("_from"), end.alias("_to"), *columns
    ), tail


def _month_schema(history: DataFrame, key: str, columns: list[str]) -> T.StructType:
    named = [T.StructField("_id", history.schema[key].dataType), *[T.StructField(c, T.DateType()) for c in ("_month", "_from", "_to")]]
    return T.StructType(named + [history.schema[c] for c in columns])


def _most_versions(history: DataFrame, key: str) -> tuple[int, bool]:
    """Versions of the longest history, and whether some member's is within ``FEW_VERSIONS``."""
    n = F.count(F.lit(1)).alias("n")
    found = history.groupBy(key).agg(n).agg(F.max("n").alias("most"), (F.min("n") <= FEW_VERSIONS).alias("few")).first()
    return found["most"] or 0, bool(found["few"])


def as_of_join(df: DataFrame, history: DataFrame, key: str, day: str, columns: list[str]) -> DataFrame:
    """Left point-in-time lookup; without match (an unknown key, a day before the first
    version or none at all) ``columns`` are NULL.

    A row meets at most ``FEW_VERSIONS`` versions, however long the member's history: shorter
    histories are joined by key as they are.  Those of the other members are dealt by month and
    joined on (key, month), so a row meets the versions of its own month, and adaptive execution
    can split a member that holds most rows by its months, and further.  Only versions of long
    histories are dealt, to at most (versions + long members x months on record).
    """
    most, some_few = _most_versions(history, key)
    if most <= FEW_VERSIONS and some_few:
        return _join_by_key(df, history, key, day, columns).drop(*_unasked(day))
    if not some_few:
        return _join_by_month(df, history, key, day, columns).drop(*_unasked(day))
    long = history.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW_VERSIONS).select(key)
    found = _join_by_key(df, history.join(long, key, "left_anti"), key, day, columns)
    aside = found.withColumnsRenamed({c: f"_few_{c}" for c in columns})
    found = _join_by_month(aside, history.join(long, key, "left_semi"), key, day, columns)
    # A member is on one side only, so at most one of the two lookups matched.
    either = {c: F.coalesce(f"_few_{c}", c) for c in columns}
    return found.withColumns(either).drop(*[f"_few_{c}" for c in columns], *_unasked(day))


def _unasked(day: str) -> list[str]:
    return [day] if day.startswith("_") else []


def _valid(day: str) -> Column:
    return (F.col("_from") <= F.col(day)) & ((F.col("_to") > F.col(day)) | F.col("_to").isNull())


def _join_by_key(df: DataFrame, history: DataFrame, key: str, day: str, columns: list[str]) -> DataFrame:
    start, end = F.col("effective_date").alias("_from"), F.col("expiration_date").alias("_to")
    versions = history.select(F.col(key).alias("_id"), start, end, *columns)
    return df.join(versions, (F.col(key) == F.col("_id")) & _valid(day), "left").drop("_id", "_from", "_to")


def _join_by_month(df: DataFrame, history: DataFrame, key: str, day: str, columns: list[str]) -> DataFrame:
    versions, tail = _by_month(history, key, columns)
    month = F.trunc(F.col(day), "month")
    rows = df.withColumn("_row_month", F.least(month, F.lit(tail)) if tail else month)
    same = (F.col(key) == F.col("_id")) & (F.col("_row_month") == F.col("_month"))
    return rows.join(versions, same & _valid(day), "left").drop("_id", "_month", "_row_month", "_from", "_to")


def latest_version(ids: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Latest version number per requested id, 0 when the id has no history."""
    top = history.groupBy(key).agg(F.max("version").alias("version"))
    return ids.select(key).join(top, key, "left").withColumn("version", F.coalesce("version", F.lit(0)))


def version_history(history: DataFrame, key: str, as_of: dt.date) -> DataFrame:
    """History with previous fare, fare change and days active."""
    by_version = Window.partitionBy(key).orderBy("version")
    previous = F.when(F.col("version") > 1, F.lag("base_fare").over(by_version))
    return history.withColumns(
        {
            "previous_fare": previous,
            "fare_change": F.col("base_fare") - previous,
            "days_active": F.datediff(F.coalesce("expiration_date", F.lit(as_of)), "effective_date"),
            "status": F.when(F.col("is_current"), STATUS_CURRENT).otherwise(STATUS_PAST),
        }
    )


def invariants(history: DataFrame, key: str) -> DataFrame:
    """Violation counts: flag against expiration, several current versions, gaps, overlaps.

    A version that is stored twice is one version; its repeat counts as an overlap.
    """
    current = F.when(F.col("is_current"), F.col("version"))
    by_start = Window.partitionBy(key).orderBy("effective_date", "version")
    chained = history.withColumn("_next", F.lead("effective_date").over(by_start))
    per_member = chained.groupBy(key).agg(
        F.count_if(F.col("is_current") != F.col("expiration_date").isNull()).alias("flag"),
        F.coalesce(F.max(current) > F.min(current), F.lit(False)).cast("int").alias("several"),
        F.count_if(F.col("_next") > F.col("expiration_date")).alias("gap"),
        F.count_if(
            (F.col("_next") < F.col("expiration_date")) | (F.col("_next").isNotNull() & F.col("expiration_date").isNull())
        ).alias("overlap"),
    )
    return per_member.agg(
        F.count(F.lit(1)).alias("members"),
        F.sum("flag").alias("flag_mismatches"),
        F.sum("several").alias("several_current"),
        F.sum("gap").alias("gaps"),
        F.sum("overlap").alias("overlaps"),
    )
