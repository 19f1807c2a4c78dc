"""Guarded ratios and rounded percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL on zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole of two counts, two digits, half up.

    Decimal division keeps .005 ties exact, which doubles do not.
    """
    exact = F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(18,0)"))
    return F.round(exact, 2).cast("double")
