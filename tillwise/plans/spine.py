"""Gap-free calendars.  A period with no sales must still appear, or ``lag`` and row frames
silently step over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_spine(series: DataFrame, date_col: str, unit: str, calendar: DataFrame) -> DataFrame:
    """``series`` (one row per period start in ``date_col``) left-joined onto every period from
    the first to the last period of ``calendar`` (a one-column frame of period starts, e.g. the
    months of the order dates).

    Taking the bounds from the cheap ``calendar`` frame keeps ``series`` to one evaluation.  The
    spine's size is bounded by the calendar span, not by data volume."""
    step = {"month": "interval 1 month", "day": "interval 1 day"}[unit]
    bounds = calendar.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr(step))).alias(date_col))
    return spine.join(series, date_col, "left")
