"""Mergeable sales sketches: one row of state per month and region, rolled up without a second scan.

A state row holds

* ``buyers``: a HyperLogLog sketch of the customers who ordered (2**BUYER_LG_K registers);
* ``line_values``: how many lines fall into each log-linear bucket of revenue, as (bucket, n) pairs.

Both merge by union or addition, in any order, so a state of months and regions gives every rollup of
them, and a newly arrived month is merged by taking its rows in (:func:`merge_states`).  The buckets keep
the leading ``VALUE_BITS + 1`` bits of an amount: at most ``2**VALUE_BITS`` buckets per doubling, so a
row's state is bounded whatever the number of lines, and the middle of a bucket is off by at most
``VALUE_ERROR`` of any amount in it.  That bound is certain; the one of the buyers is
``BUYER_ERROR``, three standard errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import month_start
from tillwise.plans.facts import dated_lines, line_measures
from tillwise.plans.regions import orders_with_region
from tillwise.sources.tables import Tables

BUYER_LG_K = 14
BUYER_ERROR = 3 * 1.04 / 2 ** (BUYER_LG_K / 2)
VALUE_BITS = 7
VALUE_ERROR = 2.0 ** -(VALUE_BITS + 1)
GRAINS = [["month", "region"], ["month"], ["region"], []]
GRAIN_NAMES = {0: "month_region", 1: "month", 2: "region", 3: "all"}


def ten_thousandths(amount: Column) -> Column:
    """A ``decimal(18,4)`` amount as a whole number."""
    return (amount * F.lit(10_000)).cast("bigint")


def as_amount(whole: Column) -> Column:
    return (whole.cast("decimal(20,0)") / F.lit(10_000).cast("decimal(5,0)")).cast("decimal(18,4)")


def value_bucket(whole: Column) -> Column:
    """The bucket of a whole number: exact below ``2**(VALUE_BITS + 1)``, its leading bits and their
    place beyond; ordered like the numbers, negative ones mirrored."""
    size = F.abs(whole)
    places = F.greatest(F.length(F.bin(size)) - F.lit(VALUE_BITS + 1), F.lit(0)).cast("int")
    return F.signum(whole).cast("bigint") * (
        places.cast("bigint") * F.lit(2 ** VALUE_BITS) + F.call_function("shiftright", size, places))


def bucket_middle(bucket: Column) -> Column:
    """The middle of a bucket (the number itself where the bucket holds one)."""
    size = F.abs(bucket)
    places = F.greatest(F.shiftright(size, VALUE_BITS) - 1, F.lit(0)).cast("int")
    lead = size - places.cast("bigint") * F.lit(2 ** VALUE_BITS)
    half = F.call_function("shiftright", F.call_function("shiftleft", F.lit(1).cast("bigint"), places), F.lit(1))
    return F.signum(bucket).cast("bigint") * (F.call_function("shiftleft", lead, places) + half)


def monthly_orders(t: Tables) -> DataFrame:
    """Orders with their month and customer's region."""
    return orders_with_region(t).select("o_orderkey", "o_custkey", month_start("order_date").alias("month"), "region")


def sales_sketches(t: Tables) -> DataFrame:
    """The state: ``month``, ``region``, ``buyers``, ``line_values``.

    Orders are sketched as they are; lines meet their order's month and region and collapse to counts
    per bucket before they are shuffled."""
    orders = monthly_orders(t)
    buyers = orders.groupBy("month", "region").agg(F.hll_sketch_agg("o_custkey", F.lit(BUYER_LG_K)).alias("buyers"))
    lines = line_measures(t).select("l_orderkey", value_bucket(ten_thousandths(F.col("revenue"))).alias("bucket"), "n_lines")
    counts = (dated_lines(t, lines, ["n_lines"], carry=("bucket",), orders=orders)
              .groupBy("month", "region", "bucket").agg(F.sum("n_lines").alias("n")))
    values = _packed(counts).select(F.col("month").alias("v_month"), F.col("region").alias("v_region"), "line_values")
    here = buyers.month.eqNullSafe(values.v_month) & buyers.region.eqNullSafe(values.v_region)
    return buyers.join(values, here, "left").select("month", "region", "buyers", "line_values")


def _packed(counts: DataFrame) -> DataFrame:
    """(month, region, bucket, n) to one row per month and region; the buckets are a bounded domain."""
    return counts.groupBy("month", "region").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("line_values"))


def _counts(state: DataFrame) -> DataFrame:
    return state.select("month", "region", F.inline("line_values"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several: the same row as if their orders and lines had been sketched together."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    buyers = every.groupBy("month", "region").agg(F.hll_union_agg("buyers").alias("buyers"))
    values = (_packed(_counts(every).groupBy("month", "region", "bucket").agg(F.sum("n").alias("n")))
              .withColumnsRenamed({"month": "v_month", "region": "v_region"}))
    here = buyers.month.eqNullSafe(values.v_month) & buyers.region.eqNullSafe(values.v_region)
    return buyers.join(values, here, "left").select("month", "region", "buyers", "line_values")


def grain_name(grouping_id: Column) -> Column:
    named = F.when(grouping_id == 0, F.lit(GRAIN_NAMES[0]))
    for code in (1, 2):
        named = named.when(grouping_id == code, F.lit(GRAIN_NAMES[code]))
    return named.otherwise(F.lit(GRAIN_NAMES[3]))


def place_of(n: Column, percent: int) -> Column:
    """The 1-based place of a percentile among ``n`` rows: the least with that share at or below it."""
    return F.greatest(F.call_function("div", n * F.lit(percent) + F.lit(99), F.lit(100)), F.lit(1))


def rollup(state: DataFrame, percents: Sequence[int] = (50, 95)) -> DataFrame:
    """Estimates by month and region, month, region and over all, from the state alone: ``grain``,
    ``month``, ``region``, ``buyers_estimate``, ``n_lines`` and ``pNN_estimate`` per percentile.

    Grouping sets run over one row per month, region and bucket, never over lines."""
    by = [F.col("month"), F.col("region")]
    sets = [[F.col(c) for c in g] for g in GRAINS]
    buyers = state.groupingSets(sets, *by).agg(
        grain_name(F.grouping_id()).alias("grain"),
        F.hll_sketch_estimate(F.hll_union_agg("buyers")).alias("buyers_estimate"))
    # grouping_id has a bit for the bucket too, which every set holds
    counts = _counts(state).groupingSets([[*s, F.col("bucket")] for s in sets], *by, F.col("bucket")).agg(
        grain_name(F.floor(F.grouping_id() / 2)).alias("grain"), F.sum("n").alias("n"))
    group = Window.partitionBy("grain", "month", "region")   # at most one row per bucket
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("n_lines", F.sum("n").over(group))
    values = placed.groupBy("grain", "month", "region").agg(
        F.max("n_lines").alias("n_lines"),
        *[F.min(F.when(F.col("upto") >= place_of(F.col("n_lines"), p), F.col("bucket"))).alias(f"b{p}") for p in percents])
    values = values.select(F.col("grain").alias("v_grain"), F.col("month").alias("v_month"), F.col("region").alias("v_region"),
                           "n_lines", *[as_amount(bucket_middle(F.col(f"b{p}"))).alias(f"p{p}_estimate") for p in percents])
    here = ((buyers.grain == values.v_grain) & buyers.month.eqNullSafe(values.v_month)
            & buyers.region.eqNullSafe(values.v_region))
    return buyers.join(values, here, "left").select(
        "grain", "month", "region", "buyers_estimate", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        *[f"p{p}_estimate" for p in percents])
