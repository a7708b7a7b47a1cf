"""Date expressions.  Order and ship times are midnight ``timestamp_ntz`` values, read as dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(col: Column | str) -> Column:
    return F.to_date(_c(col))


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "month")


def year_part(col: Column | str) -> Column:
    return F.year(_c(col)).cast("bigint")


def quarter_part(col: Column | str) -> Column:
    return F.quarter(_c(col)).cast("bigint")


def month_part(col: Column | str) -> Column:
    return F.month(_c(col)).cast("bigint")


def day_diff(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_c(end), _c(start)).cast("bigint")


def first_complete_year(earliest_date: Column) -> Column:
    """The first calendar year that data beginning at ``earliest_date`` cover from its January on
    (a year counts by its months, so sales need not begin on the first of January)."""
    return (F.year(earliest_date) + F.when(F.month(earliest_date) == 1, 0).otherwise(1)).cast("bigint")


def last_complete_year(latest_date: Column) -> Column:
    """The last calendar year that data ending at ``latest_date`` cover into its December."""
    return (F.year(latest_date) - F.when(F.month(latest_date) == 12, 0).otherwise(1)).cast("bigint")
