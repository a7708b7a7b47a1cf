"""Exploration and descriptive questions: totals, tops, stock movement, subtotals, returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import as_date, month_part, month_start, quarter_part, year_part
from tillwise.functions.measures import MONEY, QTY, UNITS, line_qty, returned
from tillwise.functions.ratios import ratio
from tillwise.plans.facts import (
    dated_lines, line_measures, per_product, product_categories, product_totals,
)
from tillwise.plans.ordering import rank_family
from tillwise.plans.regions import orders_with_region
from tillwise.sources.tables import Tables


def monthly_revenue(t: Tables) -> DataFrame:
    """``month`` (first day), ``revenue`` and ``n_lines`` by sale month: lines attached to
    their orders' dates, then at most one row per calendar month."""
    dated = dated_lines(t, line_measures(t), ["revenue", "n_lines"])
    return dated.groupBy(month_start("order_date").alias("month")).agg(
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.sum("n_lines").cast("bigint").alias("n_lines"),
    )


def revenue_by_period(t: Tables) -> DataFrame:
    """Revenue by year, quarter and month in one result (grouping sets over the monthly totals;
    the sums are additive, so regrouping the at-most-one-row-per-month table is exact)."""
    monthly = monthly_revenue(t).select(
        year_part("month").alias("year"), quarter_part("month").alias("quarter"),
        month_part("month").alias("month"), "revenue", "n_lines")
    grouped = monthly.groupingSets(
        [["year"], ["year", "quarter"], ["year", "quarter", "month"]],
        "year", "quarter", "month",
    ).agg(F.sum("revenue").cast(MONEY).alias("revenue"),
          F.sum("n_lines").cast("bigint").alias("n_lines"),
          F.grouping_id().alias("_gid"))
    grain = (F.when(F.col("_gid") == 3, "year").when(F.col("_gid") == 1, "quarter")
             .otherwise("month"))
    return grouped.select(grain.alias("grain"), "year", "quarter", "month", "revenue", "n_lines")


def revenue_rollup(t: Tables) -> DataFrame:
    """Revenue by year and quarter with year subtotals and a grand total (``rollup``)."""
    monthly = monthly_revenue(t).select(year_part("month").alias("year"),
                                        quarter_part("month").alias("quarter"), "revenue")
    return monthly.rollup("year", "quarter").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.grouping_id().cast("bigint").alias("grouping_id"))


def top_rank(totals: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """Rows of ``totals`` with ``rank() <= k`` by ``value`` descending, all ties kept, and the rank.

    The k-th value comes from a sort limited to k rows; rows at or above it hold at most k distinct
    values, whose ranks are running counts over that small table.  However many rows tie, they stay
    where they are: no task ranks them one by one.  Null values have no rank."""
    kth = totals.where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(k).select(F.min(value)).scalar()
    top = totals.where(F.col(value) >= kth)
    before = Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = top.groupBy(value).agg(F.count(F.lit(1)).alias("_rows")).select(
        value, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1).cast("bigint").alias(name))
    return top.join(F.broadcast(ranks), value)  # at most k rows


def top_products(t: Tables, k: int = 10) -> DataFrame:
    """Products by revenue, ``rank() <= k`` so ties at the cut are all kept; the product table is
    joined to the survivors only."""
    totals = line_measures(t).groupBy("l_partkey").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"))
    ranked = top_rank(totals, "revenue", k, "revenue_rank")
    products = t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"))
    return ranked.join(products, ranked.l_partkey == products.p_partkey).select(
        "p_partkey", "p_name", "category", "revenue", "revenue_rank")


def quantity_per_product(t: Tables) -> DataFrame:
    """Units sold per product; products that never sold appear with zero."""
    totals = product_totals(t)
    products = t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"))
    joined = products.join(totals, products.p_partkey == totals.l_partkey, "left")
    return joined.select(
        "p_partkey", "p_name", "category",
        F.coalesce(F.col("qty"), F.lit(0).cast(UNITS)).alias("total_qty"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("n_lines"))


def top_customers_by_orders(t: Tables, k: int = 10) -> DataFrame:
    """Customers with the most orders (rows of ``orders``), ``rank() <= k`` with ties."""
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    ranked = top_rank(counts, "n_orders", k, "order_rank")
    customers = t.customer.select("c_custkey", "c_name")
    return ranked.join(customers, ranked.o_custkey == customers.c_custkey).select(
        "c_custkey", "c_name", "n_orders", "order_rank")


def stock_movement_monthly(t: Tables) -> DataFrame:
    """Stock movement per product and ship month and its running balance.

    No stock table exists: a shipped line moves its units out, a returned line moves them back,
    both at the ship date.  Balances start at zero, so they read as cumulative change.  Lines
    are totalled per product-month first; the running-sum window then holds at most one row per
    month for any product, however hot."""
    moves = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"),
        month_start(as_date("l_shipdate")).alias("month"),
        line_qty("l_quantity").alias("q"), returned().alias("r"))
    monthly = moves.groupBy("p_partkey", "month").agg(
        F.sum("q").cast(UNITS).alias("qty_out"),
        F.sum(F.when(F.col("r"), F.col("q")).otherwise(F.lit(0).cast(QTY)))
         .cast(UNITS).alias("qty_returned"))
    net = (F.col("qty_returned") - F.col("qty_out")).cast(UNITS)
    upto = (Window.partitionBy("p_partkey").orderBy("month")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return monthly.select(
        "p_partkey", "month", "qty_out", "qty_returned", net.alias("net_qty"),
        F.sum(net).over(upto).cast(UNITS).alias("balance"))


def revenue_cube(t: Tables) -> DataFrame:
    """Revenue by customer region x product category with all subtotals (``cube``).

    Orders are tagged with the customer's region, lines meet them by order key and are summed per
    product and region; the product table and the cube see only those sums.  Lines of unknown
    products and orders of unknown customers stay, under a null category or region, so the grand
    total is all revenue."""
    tagged = orders_with_region(t).select("o_orderkey", "region")
    lines = dated_lines(t, line_measures(t), ["revenue"], carry=("l_partkey",), orders=tagged)
    sums = per_product(lines, ["region"], ["revenue"])
    products = product_categories(t)
    by_region = (sums.join(products, sums.l_partkey == products.p_partkey, "left")
                 .groupBy("region", "category").agg(F.sum("revenue").alias("revenue")))
    return by_region.cube("region", "category").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.grouping("region").cast("bigint").alias("g_region"),
        F.grouping("category").cast("bigint").alias("g_category"))


def customer_rank_family(t: Tables, tiles: int = 4) -> DataFrame:
    """All six ranking functions on the number of orders of every customer (customers without
    orders count zero and rank last), by the sliced order of :mod:`tillwise.plans.ordering`."""
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = t.customer.select("c_custkey")
    every = customers.join(counts, customers.c_custkey == counts.o_custkey, "left").select(
        "c_custkey", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n_orders"))
    fam = rank_family(every, "n_orders", "c_custkey", tiles=tiles)
    return fam.select("c_custkey", "n_orders",
                      F.col("row_number").alias("row_num"), F.col("rank").alias("rank_num"),
                      F.col("dense_rank").alias("dense_rank_num"), F.col("ntile").alias("ntile_num"),
                      F.col("percent_rank").alias("pct_rank"), "cume_dist")


def returns_by_month(t: Tables) -> DataFrame:
    """Returned lines and revenue by sale month, with return rate and returned revenue share."""
    measures = ["n_lines", "returned_lines", "revenue", "returned_revenue"]
    dated = dated_lines(t, line_measures(t), measures)
    monthly = dated.groupBy(month_start("order_date").alias("month")).agg(
        F.sum("n_lines").cast("bigint").alias("n_lines"),
        F.sum("returned_lines").cast("bigint").alias("returned_lines"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.sum("returned_revenue").cast(MONEY).alias("returned_revenue"))
    return monthly.select(
        "month", "n_lines", "returned_lines", "revenue", "returned_revenue",
        ratio(F.col("returned_lines"), F.col("n_lines")).alias("return_rate"),
        ratio(F.col("returned_revenue"), F.col("revenue")).alias("returned_revenue_share"))


def filtered_orders(t: Tables, min_total: float = 400_000.0, status: str = "F") -> DataFrame:
    """Orders above a total price with a given status, largest first.  Both predicates reach
    the Parquet scan as pushed filters."""
    return (t.orders.where((F.col("o_totalprice") > F.lit(min_total))
                           & (F.col("o_orderstatus") == F.lit(status)))
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    as_date("o_orderdate").alias("order_date"), "o_orderpriority")
            .orderBy(F.desc("o_totalprice"), "o_orderkey"))
