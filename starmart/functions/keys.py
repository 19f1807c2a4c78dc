"""YYYYMMDD / HHMMSS integer keys and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_key(c: Column | str) -> Column:
    """YYYYMM of a ``date_key``; the partition column of fact tables."""
    return F.floor(_col(c) / 100).cast("int")


def time_key(c: Column | str) -> Column:
    """Second-grain key."""
    c = _col(c)
    return F.hour(c) * 10000 + F.minute(c) * 100 + F.second(c)


def minute_key(c: Column | str) -> Column:
    """Minute-grain key, the grain of the time dimension."""
    c = _col(c)
    return F.hour(c) * 10000 + F.minute(c) * 100


def datetime_keys(c: Column | str) -> Column:
    return F.struct(date_key(c).alias("date_key"), time_key(c).alias("time_key"))


def key_of(day: dt.date) -> int:
    """``date_key`` of a known day, for predicates on a fact's key column."""
    return day.year * 10000 + day.month * 100 + day.day


def date_from_key(c: Column | str) -> Column:
    c = _col(c)
    return F.make_date(
        F.floor(c / 10000).cast("int"), F.floor(c % 10000 / 100).cast("int"), (c % 100).cast("int")
    )


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds as double, microsecond exact, NULL when either end is."""
    micros = [F.unix_micros(_col(c).cast("timestamp")) for c in (start, end)]
    return (micros[1] - micros[0]) / F.lit(1e6)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes, half rounds up."""
    return F.round(seconds_between(start, end) / 60).cast("int")
