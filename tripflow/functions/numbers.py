"""Number expressions whose rounding and NULL behaviour is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schemas import MONEY


def no_nan(value: Column) -> Column:
    """NaN means missing in the raw files, so it becomes NULL before anything compares it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def half_even_int(value: Column) -> Column:
    """DOUBLE to INTEGER with halves going to the even neighbour (a plain cast truncates)."""
    return F.rint(value).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_average(total: Column, count: Column) -> Column:
    """Average of exact decimals as a double: one division, after the exact sum."""
    return total.cast("double") / count
