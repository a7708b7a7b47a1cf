"""Diagnostic and comparative questions: growth, fastest growers, repeat purchase, slow and
underperforming products, time between purchases."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import (
    as_date, day_diff, first_complete_year, last_complete_year, month_start, year_part,
)
from tillwise.functions.measures import MONEY, UNITS
from tillwise.functions.ratios import growth, ratio
from tillwise.operators.descriptive import monthly_revenue
from tillwise.plans.facts import (
    dated_lines, line_measures, order_dates, per_product, product_categories, product_totals,
)
from tillwise.plans.ordering import global_order, ntile_of
from tillwise.plans.regions import orders_with_region, supplier_regions, to_regions
from tillwise.plans.spine import calendar_spine
from tillwise.sources.partitioned import last_month, since
from tillwise.sources.tables import Tables


def order_months(t: Tables) -> DataFrame:
    """The sale months (first days) of all orders: the calendar the monthly series span."""
    return t.orders.select(month_start(as_date("o_orderdate")).alias("month"))


def latest_order_date(t: Tables) -> Column:
    """The last sale date in the data, as a scalar subquery (evaluated once, inside the plan)."""
    return last_month(t.orders).select(F.max(as_date("o_orderdate"))).scalar()


def earliest_order_date(t: Tables) -> Column:
    """The first sale date in the data, as a scalar subquery."""
    return t.orders.select(F.min(as_date("o_orderdate"))).scalar()


def revenue_growth(t: Tables) -> DataFrame:
    """Month-over-month and year-over-year revenue growth on a gap-free month calendar.

    A month without sales has revenue 0 and the month after it has no growth (null, not
    infinity).  ``is_complete`` is false for a month the data end inside of."""
    series = calendar_spine(monthly_revenue(t).select("month", "revenue"), "month", "month",
                            order_months(t))
    rev = F.coalesce(F.col("revenue"), F.lit(0).cast(MONEY))
    # One row per calendar month: bounded by the span of the data, not its volume.
    by_month = Window.orderBy("month")
    prev_m = F.lag(rev, 1).over(by_month)
    prev_y = F.lag(rev, 12).over(by_month)
    return series.select(
        "month", rev.alias("revenue"),
        prev_m.alias("prev_month_revenue"), prev_y.alias("prev_year_revenue"),
        growth(rev, prev_m).alias("mom_growth"), growth(rev, prev_y).alias("yoy_growth"),
        (F.last_day("month") <= latest_order_date(t)).alias("is_complete"))


GROWTH_DIMS = ("category", "region")


def growth_ranking(t: Tables, dims: Sequence[str], side: str = "customer") -> DataFrame:
    """Revenue growth between the last two complete calendar years by category, region or
    both, ranked fastest first.  The region is the customer's, or with ``side="supplier"``
    (region alone) the supplying supplier's.  A year is complete if the data begin by its January and
    reach into its December; without two such years there is no row.

    Both years are summed in one pass with conditional sums.  Lines meet the orders of those years
    first and are reduced per product (and region) before the product table is joined; rows of
    unknown products, customers or suppliers stay under a null category or region."""
    dims = [d for d in GROWTH_DIMS if d in dims]
    if side == "supplier" and dims != ["region"]:
        raise ValueError("supplier side supports the region dimension alone")
    prev, cur = _years(t)
    orders = (order_dates(t).withColumn("year", year_part("order_date"))
              .where(F.col("year").between(prev, cur) & (prev >= first_complete_year(earliest_order_date(t))))
              .select("o_orderkey", "o_custkey", "year"))
    tagged = "region" in dims and "category" in dims
    if tagged:  # the lines then meet the region with their order, not with another join
        orders = orders_with_region(t, orders)
    carry = ("l_suppkey",) if side == "supplier" else ("l_partkey",) if "category" in dims else ()
    dated = dated_lines(t, line_measures(t), ["revenue"], carry=carry, orders=orders)
    zero = F.lit(0).cast(MONEY)
    split = dated.select(
        "o_custkey", *carry, *(["region"] if tagged else []),
        F.when(F.col("year") == prev, F.col("revenue")).otherwise(zero).alias("revenue_prev"),
        F.when(F.col("year") == cur, F.col("revenue")).otherwise(zero).alias("revenue_cur"))
    measures = ["revenue_prev", "revenue_cur"]
    if side == "supplier":
        totals = supplier_regions(split, t, measures)
    elif "category" in dims:
        sums = per_product(split, ["region"] if tagged else [], measures)
        products = product_categories(t)
        totals = (sums.join(products, sums.l_partkey == products.p_partkey, "left")
                  .groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures]))
    else:
        totals = to_regions(split, t, measures)
    return _rank_growth(totals, dims, prev, cur)


def _years(t: Tables) -> tuple[Column, Column]:
    cur = last_complete_year(latest_order_date(t))
    return cur - 1, cur


def _rank_growth(totals: DataFrame, dims: Sequence[str], prev: Column, cur: Column) -> DataFrame:
    rp = F.coalesce(F.col("revenue_prev"), F.lit(0)).cast(MONEY)
    rc = F.coalesce(F.col("revenue_cur"), F.lit(0)).cast(MONEY)
    out = totals.select(*dims, prev.alias("prev_year"), cur.alias("cur_year"),
                        rp.alias("revenue_prev"), rc.alias("revenue_cur"),
                        growth(rc, rp).alias("growth"))
    # At most categories x regions rows: a bounded domain.
    fastest = Window.orderBy(F.desc_nulls_last("growth"))
    return out.withColumn("growth_rank", F.rank().over(fastest).cast("bigint"))


def repeat_rate_by_region(t: Tables, min_orders: int = 2) -> DataFrame:
    """Share of buying customers with at least ``min_orders`` orders, per customer region."""
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    flags = per_customer.select(
        "o_custkey", F.lit(1).cast("bigint").alias("buyers"),
        F.when(F.col("n") >= min_orders, 1).otherwise(0).cast("bigint").alias("repeat_buyers"))
    by_region = to_regions(flags, t, ["buyers", "repeat_buyers"])
    return by_region.select(
        "region", F.lit(min_orders).cast("bigint").alias("min_orders"),
        F.col("buyers").cast("bigint").alias("buyers"),
        F.col("repeat_buyers").cast("bigint").alias("repeat_buyers"),
        ratio(F.col("repeat_buyers"), F.col("buyers")).alias("repeat_rate"))


def recent_orders(t: Tables, days: int) -> DataFrame:
    """Orders in the ``days`` days ending at the latest sale date (inclusive)."""
    latest = latest_order_date(t)
    return order_dates(recent_tables(t, days)).where(F.col("order_date") > F.date_sub(latest, days)).select("o_orderkey")


def recent_tables(t: Tables, days: int) -> Tables:
    """``t`` with orders and lines from the month in which the last ``days`` days begin, if they are
    laid out by month; else ``t``."""
    first = F.date_sub(latest_order_date(t), days - 1)
    return t.replace(orders=since(t.orders, first), lineitem=since(t.lineitem, first))


def slow_movers(t: Tables, days: int = 90, tiles: int = 4) -> DataFrame:
    """Every product with units sold in the recent window and its ``ntile`` (ascending units,
    then key); ``is_slow`` marks the lowest tile.  Unsold products count with zero units.

    The tile comes from an exact global position (:func:`global_order`)."""
    totals = product_totals(recent_tables(t, days), recent_orders(t, days))
    products = t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"))
    joined = products.join(totals, products.p_partkey == totals.l_partkey, "left").select(
        "p_partkey", "p_name", "category",
        F.coalesce(F.col("qty"), F.lit(0).cast(UNITS)).alias("recent_qty"))
    ordered = global_order(joined, [F.col("recent_qty").asc(), F.col("p_partkey").asc()])
    tile = ntile_of(F.col("position"), F.col("n_rows"), tiles)
    return ordered.select("p_partkey", "p_name", "category", "recent_qty",
                          tile.alias("quartile"), (tile == 1).alias("is_slow"))


def underperformers(t: Tables, factor: Decimal = Decimal("0.5")) -> DataFrame:
    """Products whose revenue is below ``factor`` times the average product of their category
    (unsold products count, with zero).

    The category average is an aggregate joined back by category (one row per category), not a
    window over the category, so no task has to hold a whole category."""
    totals = product_totals(t)
    products = t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"))
    per_product = products.join(totals, products.p_partkey == totals.l_partkey, "left").select(
        "p_partkey", "p_name", "category",
        F.coalesce(F.col("revenue"), F.lit(0).cast(MONEY)).alias("revenue"))
    per_category = per_product.groupBy("category").agg(
        F.sum("revenue").alias("cat_revenue"), F.count(F.lit(1)).alias("cat_products"))
    joined = per_product.join(per_category, "category")
    below = F.col("revenue") * F.col("cat_products") < F.col("cat_revenue") * F.lit(factor)
    avg = F.col("cat_revenue").cast("double") / F.col("cat_products").cast("double")
    return joined.where(below).select(
        "p_partkey", "p_name", "category", "revenue",
        avg.alias("category_avg_revenue"),
        ratio(F.col("revenue"), avg).alias("revenue_to_avg"))


def unsold_products(t: Tables, days: int = 90) -> DataFrame:
    """Products with no line in the recent window (anti-join against the distinct products
    sold, de-duplicated map-side before the exchange)."""
    sold = (recent_tables(t, days).lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
            .join(recent_orders(t, days), "o_orderkey", "left_semi")
            .select(F.col("l_partkey").alias("p_partkey")).distinct())
    return (t.part.join(sold, "p_partkey", "left_anti")
            .select("p_partkey", "p_name", F.col("p_type").alias("category")))


def avg_purchase_gap(t: Tables) -> DataFrame:
    """Average days between consecutive orders per customer.

    The gaps telescope: their sum is last minus first order date, so the mean is
    ``(last - first) / (orders - 1)`` from one aggregate, with no sort and no window.  Null for
    a customer with a single order."""
    per_customer = order_dates(t).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))
    n = F.col("n_orders")
    gap = F.when(n > 1, day_diff("last_order_date", "first_order_date").cast("double")
                 / (n - 1).cast("double"))
    return per_customer.select("o_custkey", "n_orders", "first_order_date", "last_order_date",
                               gap.alias("avg_gap_days"))


def purchase_gaps(t: Tables) -> DataFrame:
    """Every order with its customer's previous order date (ordered by date, then order key)
    and the gap in days; null for a customer's first order, 0 for a second order on one day.

    Instead of a window over each customer's orders (one task per customer, unbounded for a hot
    customer), orders are reduced to distinct (customer, day) rows; the window runs over those,
    bounded by the calendar, and each order is joined back to its day.  Orders without a customer
    are one group, as in a window partitioned by customer."""
    orders = order_dates(t)
    days = orders.groupBy("o_custkey", "order_date").agg(F.min("o_orderkey").alias("first_key"))
    by_day = Window.partitionBy("o_custkey").orderBy("order_date")
    days = days.withColumn("prev_day", F.lag("order_date").over(by_day))
    days = days.select(F.col("o_custkey").alias("d_custkey"), F.col("order_date").alias("d_date"),
                       "first_key", "prev_day")
    joined = orders.join(days, orders.o_custkey.eqNullSafe(days.d_custkey)
                         & orders.order_date.eqNullSafe(days.d_date))
    prev = F.when(F.col("o_orderkey") == F.col("first_key"), F.col("prev_day")).otherwise(
        F.col("order_date"))
    return joined.select("o_orderkey", "o_custkey", "order_date", prev.alias("prev_order_date"),
                         day_diff("order_date", prev).alias("gap_days"))


def purchase_gap_summary(t: Tables) -> DataFrame:
    """Time between consecutive purchases of a customer, over all customers (scope ``all``) and per
    region (scope ``region``): number of gaps, their total days, mean and exact median.

    A gap is a number of days bounded by the calendar, so the gaps reduce to counts per (customer,
    gap), then per (region, gap); the median is read off the running counts of that small table.
    Orders without a customer have no gaps here; customers of unknown region have a null region."""
    gaps = purchase_gaps(t).where(F.col("o_custkey").isNotNull() & F.col("gap_days").isNotNull())
    counts = to_regions(gaps.select("o_custkey", "gap_days", F.lit(1).cast("bigint").alias("n")), t, ["n"], ["gap_days"])
    every = counts.groupBy("gap_days").agg(F.sum("n").alias("n")).select(
        F.lit("all").alias("scope"), F.lit(None).cast("string").alias("region"), "gap_days", "n")
    both = every.union(counts.select(F.lit("region").alias("scope"), "region", "gap_days", "n"))
    scope = Window.partitionBy("scope", "region")
    upto = scope.orderBy("gap_days").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(scope))
    at = lambda place: F.min(F.when(F.col("upto") >= F.floor(place), F.col("gap_days")))
    return placed.groupBy("scope", "region").agg(
        F.sum("n").cast("bigint").alias("n_gaps"),
        F.sum(F.col("n") * F.col("gap_days")).cast("bigint").alias("total_gap_days"),
        ratio(F.sum(F.col("n") * F.col("gap_days")), F.sum("n")).alias("avg_gap_days"),
        ((at((F.col("total") + 1) / 2) + at((F.col("total") + 2) / 2)) / F.lit(2.0)).cast("double").alias("median_gap_days"))
