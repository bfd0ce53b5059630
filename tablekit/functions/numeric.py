"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate_per_hour(amount: Column, minutes: Column) -> Column:
    """``amount / (minutes / 60)``; NULL for zero minutes instead of an error."""
    return F.try_divide(amount, minutes / 60)


def nonneg(value: Column) -> Column:
    """The value where it is ``>= 0`` (zero included), NULL elsewhere."""
    return F.when(value >= 0, value)


def negative(value: Column) -> Column:
    """The value where it is ``< 0``, NULL elsewhere."""
    return F.when(value < 0, value)
