"""Interval join: pairs of spans of one key that overlap.

A span is laid into every calendar bucket of ``bucket_days`` that it touches, so overlapping spans share
a bucket and meet in an equi-join on key and bucket, which AQE splits where a key is hot.  Pairs that
share several buckets would meet several times; only the bucket in which the later of the two begins
owns the pair.  The overlap itself is then checked on the dates.

A span of n days is laid into n / ``bucket_days`` buckets.  Where one side has at most a few spans per key,
buckets only multiply the other side: without them each of its rows meets those few spans once.  The rows of a
key are then dealt to ``SLICES`` slices, each with all its spans, so a hot key is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01"
SLICES = 4


def _bucket(day: Column, bucket_days: int) -> Column:
    days = F.datediff(day, F.lit(EPOCH).cast("date"))
    return F.floor(days / F.lit(bucket_days)).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str],
                 right_span: tuple[str, str], bucket_days: int | None = 32) -> DataFrame:
    """All pairs of ``left`` and ``right`` rows with equal ``keys`` whose spans [start, end) share a day:
    the columns of both, the keys once.  Spans that are empty or lack a date, and null keys, match
    nothing.  Columns other than the keys must have different names on the two sides.  Without
    ``bucket_days`` no span is laid: each left row meets all right spans of its keys, which must be few."""
    def laid(df: DataFrame, span: tuple[str, str], prefix: str) -> DataFrame:
        start, end = F.col(span[0]), F.col(span[1])
        if bucket_days:
            bucket = F.explode(F.sequence(_bucket(start, bucket_days), _bucket(F.date_sub(end, 1), bucket_days)))
        elif prefix:
            bucket = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SLICES)]))
        else:
            bucket = F.pmod(F.xxhash64(*df.columns), F.lit(SLICES))
        named = df.where(start < end).withColumn("_bucket", bucket)
        return named.withColumnsRenamed({k: f"{prefix}{k}" for k in keys}) if prefix else named

    a, b = laid(left, left_span, ""), laid(right, right_span, "_r_").withColumnRenamed("_bucket", "_r_bucket")
    meets = a["_bucket"] == b["_r_bucket"]
    for k in keys:
        meets = meets & (a[k] == b[f"_r_{k}"])
    overlaps = (F.col(left_span[0]) < F.col(right_span[1])) & (F.col(right_span[0]) < F.col(left_span[1]))
    if bucket_days:
        overlaps = overlaps & (F.col("_bucket") == _bucket(F.greatest(left_span[0], right_span[0]), bucket_days))
    return a.join(b, meets & overlaps).drop("_bucket", "_r_bucket", *[f"_r_{k}" for k in keys])
