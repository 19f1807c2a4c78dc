"""Bucket functions over scalar columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.sources.reference_rows import OCCUPANCY_LEVELS

# Boundaries and labels of the warehouse contract.
AGE_GROUPS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 50, "36-50")]
AGE_OLDEST = "51+"
AGE_MINOR = "under 18"
AGE_UNKNOWN = "unknown"
DAY_PERIODS = [(6, 12, "morning"), (12, 18, "afternoon"), (18, 22, "evening")]
DAY_PERIOD_ELSE = "night"
RUSH_HOURS = [(7, 10, "morning_rush"), (17, 20, "evening_rush")]
MAINTENANCE_DAYS = [(30, "up_to_date"), (60, "due_soon")]
MAINTENANCE_ELSE = "overdue"
ACTIVITY_SEGMENTS = [(20, "frequent"), (5, "occasional"), (1, "rare")]
ACTIVITY_ELSE = "churned"


def _first_match(cases: list[tuple[Column, Column]], default: Column) -> Column:
    return F.coalesce(*[F.when(cond, value) for cond, value in cases], default)


def age_group(birth: Column, as_of: dt.date) -> Column:
    """Age by year difference; unknown birthdays and minors get labels of their own."""
    age = F.lit(as_of.year) - F.year(birth)
    cases = [(birth.isNull(), F.lit(AGE_UNKNOWN)), (age < AGE_GROUPS[0][0], F.lit(AGE_MINOR))]
    cases += [(age.between(low, high), F.lit(label)) for low, high, label in AGE_GROUPS]
    return _first_match(cases, F.lit(AGE_OLDEST))


def day_period(hour: Column) -> Column:
    cases = [((hour >= a) & (hour < b), F.lit(label)) for a, b, label in DAY_PERIODS]
    return _first_match(cases, F.lit(DAY_PERIOD_ELSE))


def rush_hour_type(hour: Column) -> Column:
    cases = [((hour >= a) & (hour < b), F.lit(label)) for a, b, label in RUSH_HOURS]
    return _first_match(cases, F.lit(None).cast("string"))


def is_rush_hour(hour: Column) -> Column:
    return rush_hour_type(hour).isNotNull()


def maintenance_status(last_maintenance: Column, as_of: dt.date) -> Column:
    days = F.datediff(F.lit(as_of), last_maintenance)
    cases = [(days <= limit, F.lit(label)) for limit, label in MAINTENANCE_DAYS]
    return _first_match(cases, F.lit(MAINTENANCE_ELSE))


def activity_segment(recent_trips: Column) -> Column:
    cases = [(recent_trips >= floor, F.lit(label)) for floor, label in ACTIVITY_SEGMENTS]
    return _first_match(cases, F.lit(ACTIVITY_ELSE))


def occupancy_code(percent: Column) -> Column:
    """Occupancy level of a percentage; where ranges overlap the one that starts later wins."""
    ranges = sorted(((low, high, code) for code, _, low, high, *_ in OCCUPANCY_LEVELS if low is not None), reverse=True)
    cases = [(percent.between(low, high), F.lit(code)) for low, high, code in ranges]
    return _first_match(cases, F.lit(None).cast("string"))
