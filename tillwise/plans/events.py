"""Levels from entry and exit events.

A quantity that holds over a span (revenue within the last 90 days, customers active, units under way)
enters at the span's first day and leaves on the day after its last.  The events are summed per day, so
however many spans there are, what is left is at most one row per key and calendar day, and one running
sum gives the level; no span is expanded into its days and no row looks back over a frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def span_events(spans: DataFrame, keys: Sequence[str], start: str, end: str, amounts: Sequence[str], day: str = "day"
                ) -> DataFrame:
    """Entry (+amount on ``start``) and exit (-amount on ``end``, exclusive) of each span, summed per
    ``keys`` and day.  A null ``end`` is a span that stays open."""
    moves = F.array(F.struct(F.col(start).alias(day), *[F.col(a).alias(f"_{a}") for a in amounts]),
                    F.struct(F.col(end).alias(day), *[(-F.col(a)).alias(f"_{a}") for a in amounts]))
    return (spans.select(*keys, F.inline(moves)).where(F.col(day).isNotNull())
            .groupBy(*keys, day).agg(*[F.sum(f"_{a}").alias(a) for a in amounts]))


def running_levels(events: DataFrame, keys: Sequence[str], amounts: Sequence[str], day: str = "day") -> DataFrame:
    """``events`` (one row per key and day) with each amount replaced by its running sum.  The window
    holds at most one row per calendar day of a key."""
    upto = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.select(*keys, day, *[F.sum(a).over(upto).alias(a) for a in amounts])


def every_day(events: DataFrame, keys: Sequence[str], amounts: Sequence[str], first: Column, last: Column,
              day: str = "day") -> DataFrame:
    """Levels of every key on every day from ``first`` to ``last``: a running sum over a calendar, with
    events before it counted in.  Rows are keys times days."""
    groups = events.groupBy(*keys).agg(F.min(day).alias("_first"))
    days = groups.select(*keys, F.explode(F.sequence(F.least("_first", first), last)).alias(day))
    named = {k: f"_k{i}" for i, k in enumerate(keys)} | {day: "_day"}
    other = events.withColumnsRenamed(named)
    same = days[day] == other["_day"]
    for k in keys:
        same = same & days[k].eqNullSafe(other[named[k]])
    filled = days.join(other, same, "left").select(
        *keys, day, *[F.coalesce(F.col(a), F.lit(0)).alias(a) for a in amounts])
    return running_levels(filled, keys, amounts, day).where(F.col(day) >= first)


def merged_presence(days: DataFrame, keys: Sequence[str], day: str, length: int) -> DataFrame:
    """Spans during which a key was seen on one of the last ``length`` days, from its distinct days:
    ``start`` and ``end`` (exclusive), touching spans merged.  One row per entry and one per exit would
    count twice within a span, so a day only opens a span if none was open, and closes one if the next
    comes too late.  The window holds at most one row per calendar day of a key."""
    order = Window.partitionBy(*keys).orderBy(day)
    opens = F.lag(day).over(order).isNull() | (F.datediff(day, F.lag(day).over(order)) > length)
    closes = F.lead(day).over(order).isNull() | (F.datediff(F.lead(day).over(order), day) > length)
    marked = days.select(*keys, day, opens.alias("_opens"), closes.alias("_closes"))
    edges = marked.where(F.col("_opens") | F.col("_closes")).select(
        *keys, F.when(F.col("_opens"), F.col(day)).alias("start"),
        F.when(F.col("_closes"), F.date_add(day, length)).alias("end"))
    return edges
