"""How line values and buyers are distributed: mergeable sketches and exact percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.plans.facts import dated_lines, line_measures, product_categories
from tillwise.plans.regions import orders_with_region
from tillwise.plans.selection import exact_percentiles
from tillwise.plans.sketches import (
    BUYER_ERROR, GRAIN_NAMES, VALUE_BITS, as_amount, monthly_orders, rollup, sales_sketches, ten_thousandths,
)
from tillwise.sources.sinks import stored
from tillwise.sources.tables import Tables


def sketch_state(t: Tables) -> DataFrame:
    """:func:`sales_sketches`, stored by month and read back: the rollups below read only this."""
    return stored(sales_sketches(t), "sales-sketches", partition_by=["month"])


def value_sketch_rollup(t: Tables) -> DataFrame:
    """Line count and estimated median and 95th percentile of line revenue by month and region, month,
    region and over all, merged from the stored sketches."""
    return rollup(sketch_state(t)).drop("buyers_estimate")


def sketch_accuracy(t: Tables) -> DataFrame:
    """Exact buyers and line-revenue percentiles at every grain of the rollup, and whether the merged
    sketches are within their stated error of them."""
    orders = monthly_orders(t)
    # A grain's absent dimensions are null; the grain's name tells them from unknown regions.
    none_m, none_r = F.lit(None).cast("date"), F.lit(None).cast("string")
    grains = F.array(*[F.struct(F.lit(GRAIN_NAMES[code]).alias("grain"),
                                (none_m if code & 2 else F.col("month")).alias("month"),
                                (none_r if code & 1 else F.col("region")).alias("region")) for code in GRAIN_NAMES])
    keys = ["grain", "month", "region"]
    buyers = (orders.select("o_custkey", "month", "region").distinct().select("o_custkey", F.inline(grains)).distinct()
              .groupBy(*keys).agg(F.count("o_custkey").alias("buyers")))
    lines = line_measures(t).select("l_orderkey", ten_thousandths(F.col("revenue")).alias("value"), "n_lines")
    values = dated_lines(t, lines, ["n_lines"], carry=("value",), orders=orders).select("value", "month", "region")
    exact = exact_percentiles(values, keys, "value", [50, 95], base=["month", "region"], groups=grains).withColumnsRenamed({k: f"e_{k}" for k in keys})
    found = rollup(sketch_state(t)).withColumnsRenamed({k: f"s_{k}" for k in keys} | {"n_lines": "s_lines"})
    same = lambda other, p: ((buyers.grain == other[f"{p}_grain"]) & buyers.month.eqNullSafe(other[f"{p}_month"])
                             & buyers.region.eqNullSafe(other[f"{p}_region"]))
    joined = buyers.join(exact, same(exact, "e"), "left").join(found, same(found, "s"), "left")

    def within(p: int):
        off = F.abs(ten_thousandths(F.col(f"p{p}_estimate")) - F.col(f"p{p}"))
        return (off * F.lit(2 ** (VALUE_BITS + 1)) <= F.abs(F.col(f"p{p}"))).alias(f"p{p}_within")

    return joined.select(
        *keys, F.col("buyers").cast("bigint").alias("buyers"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_lines"),
        as_amount(F.col("p50")).alias("p50"), as_amount(F.col("p95")).alias("p95"),
        (F.abs(F.col("buyers_estimate") - F.col("buyers")) <= F.lit(BUYER_ERROR) * F.col("buyers")).alias("buyers_within"),
        within(50), within(95))


def line_value_percentiles(t: Tables, percents: Sequence[int] = (50, 95)) -> DataFrame:
    """Exact percentiles of line revenue per category and customer region.

    Lines meet their order and its region, equal (product, region, value) rows collapse, and only then
    do they meet the product table; the selection never gathers a group."""
    orders = orders_with_region(t).select("o_orderkey", "region")
    lines = line_measures(t).select("l_orderkey", "l_partkey", ten_thousandths(F.col("revenue")).alias("value"), "n_lines")
    dated = dated_lines(t, lines, ["n_lines"], carry=("l_partkey", "value"), orders=orders)
    counts = dated.groupBy("l_partkey", "region", "value").agg(F.sum("n_lines").alias("n_lines"))
    products = product_categories(t)
    tagged = counts.join(products, counts.l_partkey == products.p_partkey, "left")
    found = exact_percentiles(tagged, ["category", "region"], "value", percents, weight="n_lines")
    return found.select("category", "region", F.col("n").cast("bigint").alias("n_lines"),
                        *[as_amount(F.col(f"p{p}")).alias(f"p{p}") for p in percents])
