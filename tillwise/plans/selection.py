"""Exact percentiles of an unbounded domain, for many groups at once, by distributed selection.

A percentile needs the value at one place of a group's order, not the order.  Every round counts, per
group, how many values fall into each of ``2**DIGIT_BITS`` slices of the range still open, finds the slice
that holds the wanted place, and keeps only the values in it; after as many rounds as the range has
digits, the slice is one value.  Counts are combined before they are shuffled, so a group of a third of
all rows costs a task no more than any other: no group is ever sorted, collected or sent to one task, and
the windows that find the slice run over at most ``2**DIGIT_BITS`` counts.

The slices found are stored before the values meet them: their size is then known, so few of them are
broadcast and the values stay where they are, and only as many as do not fit a broadcast are shuffled to.
Where a value counts in several groups (months and years, say), it is stored once, and counted at the
finest groups before its counts are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.plans.sketches import place_of
from tillwise.sources.sinks import stored

DIGIT_BITS = 10


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int],
                      weight: str | None = None, digit_bits: int = DIGIT_BITS, base: Sequence[str] = (),
                      groups: Column | None = None) -> DataFrame:
    """Per group of ``keys``: ``n`` values and ``pNN``, the least value of whole-number column ``value``
    with at least NN% of the group's values at or below it.  Null values do not count; null keys are a
    group.  ``weight`` says how many values a row stands for.  With ``groups``, an array of structs of the
    ``keys`` made from the columns ``base``, a row counts in each of these groups.

    The narrowed columns are stored once and read every round.  The rounds but the last run when this is
    called, as does the look at the range of the values, to know their number (one row reaches the driver)."""
    held = list(keys if groups is None else base)
    one = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    narrow = stored(rows.select(*held, F.col(value).cast("bigint").alias("_v"), one.alias("_w"))
                    .where(F.col("_v").isNotNull() & (F.col("_w") > 0)), "percentile-values")
    low, high = narrow.agg(F.min("_v"), F.max("_v")).first()
    span = (high - low) if low is not None else 0
    if span >= 1 << 63:
        raise ValueError("the values span more than 63 bits")
    rounds = max(1, -(-span.bit_length() // digit_bits))
    shifted = narrow.withColumn("_u", F.col("_v") - F.lit(low or 0))

    def digits(left: int):
        """The value without its last ``left`` digits."""
        return F.shiftright("_u", digit_bits * left)

    def grouped(df: DataFrame, *columns: str) -> DataFrame:
        return df if groups is None else df.select(*columns, F.inline(groups))

    first = digits(rounds - 1)
    counts = shifted.groupBy(*held, first.alias("_d")).agg(F.sum("_w").alias("_c"))
    if groups is not None:
        counts = grouped(counts, "_d", "_c").groupBy(*keys, "_d").agg(F.sum("_c").alias("_c"))
    group = Window.partitionBy(*keys)
    counts = counts.withColumn("_n", F.sum("_c").over(group)).withColumn(
        "_upto", F.sum("_c").over(group.orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    wanted = F.array(*[F.struct(F.lit(p).alias("_p"), place_of(F.col("_n"), p).alias("_left")) for p in percents])
    found = (counts.select("*", F.inline(wanted))
             .where((F.col("_left") <= F.col("_upto")) & (F.col("_left") > F.col("_upto") - F.col("_c")))
             .select(*keys, "_p", "_n", (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_left"), F.col("_d").alias("_at")))
    values = grouped(shifted, "_u", "_w")
    for left in range(rounds - 2, -1, -1):
        names = {k: f"_k{i}" for i, k in enumerate(keys)}
        asked = stored(found, "percentile-slices").withColumnsRenamed(names)
        meets = digits(left + 1) == asked["_at"]
        for k, named in names.items():
            meets = meets & values[k].eqNullSafe(asked[named])
        carried = ["_p", "_n", "_left", "_at"]
        counts = (values.join(asked, meets).groupBy(*keys, *carried, digits(left).alias("_d"))
                  .agg(F.sum("_w").alias("_c")))
        upto = Window.partitionBy(*keys, "_p").orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (counts.withColumn("_upto", F.sum("_c").over(upto))
                 .where((F.col("_left") <= F.col("_upto")) & (F.col("_left") > F.col("_upto") - F.col("_c")))
                 .select(*keys, "_p", "_n", (F.col("_left") - F.col("_upto") + F.col("_c")).alias("_left"), F.col("_d").alias("_at")))
    exact = F.col("_at") + F.lit(low or 0)
    return found.groupBy(*keys).agg(
        F.max("_n").alias("n"), *[F.max(F.when(F.col("_p") == p, exact)).alias(f"p{p}") for p in percents])
