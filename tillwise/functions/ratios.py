"""Null-safe ratios.  ANSI mode raises on division by zero; a business ratio with an empty or
zero base is unknown, so it becomes null instead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, null when the denominator is null or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth(current: Column, previous: Column) -> Column:
    """Relative change ``(current - previous) / previous``; null without a non-zero base."""
    return ratio(current - previous, previous)
