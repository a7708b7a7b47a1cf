"""As-of join: each left row with the last right row of its key before it.

Both sides are laid into one global order of key, time and side (:func:`ordered_slices`: range-partitioned,
so a key of a third of all rows fills many slices, and checkpointed, so the slices stay what they are).
Within a slice the last right row is carried forward by a window; what a slice hands on is one row, the
last right row in it, and because slices follow the key order, a left row that finds nothing in its own
slice needs exactly the last right row of the slices before, if that has its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.plans.ordering import ordered_slices


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], strict: bool = True, slices: int | None = None) -> DataFrame:
    """``left`` with the columns ``right_time`` and ``values`` of the last ``right`` row of the same
    ``keys`` whose time is before the left row's (``strict``), or not after it; null without one.

    Keys match null-safely; a right row without a time is ignored, a left row without one finds nothing.
    Of right rows with one key and time the greatest ``values`` count.  Columns of ``left`` must not be
    named like those taken from ``right``."""
    taken = F.struct(right_time, *values)
    before = 1 if strict else -1
    rights = right.where(F.col(right_time).isNotNull()).select(
        *keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast("bigint").alias("_n"),
        F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType).alias("_left"),
        taken.alias("_right"))
    lefts = left.select(
        *keys, F.col(left_time).alias("_t"), F.lit(-before).alias("_side"), F.monotonically_increasing_id().alias("_n"),
        F.struct(*left.columns).alias("_left"), F.lit(None).cast(rights.schema["_right"].dataType).alias("_right"))
    # Nulls first: a left row without a time comes before all rights of its key.
    total = [*[F.col(k).asc() for k in keys], F.col("_t").asc(), F.col("_side").asc(), F.col("_right").asc(), F.col("_n").asc()]
    ordered = ordered_slices(lefts.unionByName(rights), total, slices)

    upto = (Window.partitionBy("_slice", *keys).orderBy(*total[len(keys):])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ordered.withColumn("_own", F.last("_right", ignorenulls=True).over(upto)).where(F.col("_left").isNotNull())

    place = F.struct(*keys, "_t", "_right")
    lasts = ordered.groupBy("_slice").agg(
        F.max_by(F.struct(*keys, "_right"), F.when(F.col("_right").isNotNull(), place)).alias("_last"))
    # One row per slice: bounded by the number of slices.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = lasts.select(F.col("_slice").alias("_to"), F.last("_last", ignorenulls=True).over(earlier).alias("_handed"))
    joined = local.join(F.broadcast(handed), local["_slice"] == handed["_to"], "left")
    same = F.col("_t").isNotNull() & F.col("_handed").isNotNull()
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_handed.{k}"))
    found = F.coalesce(F.col("_own"), F.when(same, F.col("_handed._right")))
    return joined.select("_left.*", *[found[c].alias(c) for c in (right_time, *values)])
