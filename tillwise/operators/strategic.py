"""Profitability and strategic questions: lifetime value, Pareto shares, moving averages,
margin trends, contribution margin and a KPI summary.

Profit rests on the cost stand-in of :func:`tillwise.functions.measures.unit_cost`."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import as_date, day_diff, month_start
from tillwise.functions.measures import DEFAULT_COST_RATIO, MONEY, UNITS, line_cost
from tillwise.functions.ratios import ratio
from tillwise.operators.descriptive import monthly_revenue
from tillwise.operators.diagnostic import latest_order_date, order_months
from tillwise.plans.facts import (
    attach, costed, customer_profit, dated_lines, line_measures, order_dates, per_product,
    product_costs, product_profit,
)
from tillwise.plans.ordering import global_order
from tillwise.plans.spine import calendar_spine
from tillwise.sources.tables import Tables


def customer_ltv(t: Tables, horizon_years: int = 3, min_tenure_days: int = 365,
                 cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Historic lifetime value (total profit) per customer and a projection over
    ``horizon_years``: profit per day of tenure (first order to the latest sale date in the
    data) times the horizon.  Customers with less than ``min_tenure_days`` of tenure get no
    projection, since a short history extrapolates wildly."""
    cust = customer_profit(t, cost_ratio)
    tenure = day_diff(latest_order_date(t), "first_order_date")
    profit = (F.col("revenue") - F.col("cost")).cast(MONEY)
    projected = F.when(
        tenure >= min_tenure_days,
        ratio(profit, tenure) * F.lit(365.25) * F.lit(float(horizon_years)))
    return cust.select(
        "o_custkey", "n_orders", "revenue", "cost", "uncosted_lines", profit.alias("profit"),
        ratio(F.col("revenue"), F.col("n_orders")).alias("aov"),
        ratio(profit, F.col("revenue")).alias("margin"),
        "first_order_date", tenure.alias("tenure_days"),
        projected.alias("projected_ltv"))


def pareto(entity_profit: DataFrame, key: str, share: Decimal = Decimal("0.2")) -> DataFrame:
    """Entities ordered by profit (descending, key ascending) with position, cumulative profit
    and cumulative share; ``is_top`` marks the first ``ceil(share * N)``.  With negative
    profits the cumulative share can pass 1 before it falls back; a zero total gives null."""
    ordered = global_order(entity_profit.select(key, "profit"),
                           [F.col("profit").desc(), F.col(key).asc()], sums=["profit"])
    top_n = F.ceil(F.col("n_rows") * F.lit(share))
    return ordered.select(
        key, "profit", F.col("position").alias("profit_rank"),
        F.col("running_profit").cast(MONEY).alias("cum_profit"),
        ratio(F.col("running_profit"), F.col("total_profit")).alias("cum_share"),
        (F.col("position") <= top_n).alias("is_top"))


def pareto_products(t: Tables, share: Decimal = Decimal("0.2"),
                    cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    return pareto(product_profit(t, cost_ratio), "p_partkey", share)


def pareto_customers(t: Tables, share: Decimal = Decimal("0.2"),
                     cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Every customer (none-buyers with zero profit) by profit."""
    cust = customer_profit(t, cost_ratio, dates=False)
    customers = t.customer.select("c_custkey")
    joined = customers.join(cust, customers.c_custkey == cust.o_custkey, "left")
    profit = F.coalesce((F.col("revenue") - F.col("cost")).cast(MONEY), F.lit(0).cast(MONEY))
    return pareto(joined.select("c_custkey", profit.alias("profit")), "c_custkey", share)


def _moving_average(series: DataFrame, date_col: str, n: int) -> DataFrame:
    """Trailing ``n``-period mean of revenue over a gap-free calendar, current period included.
    Leading periods average over a shorter frame, whose row count is reported."""
    rev = F.coalesce(F.col("revenue"), F.lit(0).cast(MONEY))
    # One row per calendar period: the unpartitioned frame is bounded by the data's span.
    frame = Window.orderBy(date_col).rowsBetween(-(n - 1), Window.currentRow)
    total = F.sum(rev).over(frame)
    rows = F.count(F.lit(1)).over(frame)
    return series.select(date_col, rev.alias("revenue"),
                         ratio(total, rows).alias("moving_avg"),
                         rows.cast("bigint").alias("frame_rows"))


def moving_avg_month(t: Tables, n: int = 3) -> DataFrame:
    """Trailing ``n``-month mean revenue; ``is_complete`` is false for a month the data end
    inside of (its revenue, and so its average, covers part of the month)."""
    series = calendar_spine(monthly_revenue(t).select("month", "revenue"), "month", "month",
                            order_months(t))
    return _moving_average(series, "month", n).withColumn(
        "is_complete", F.last_day("month") <= latest_order_date(t))


def daily_revenue(t: Tables) -> DataFrame:
    dated = dated_lines(t, line_measures(t), ["revenue"])
    return dated.groupBy("order_date").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"))


def moving_avg_day(t: Tables, n: int = 7) -> DataFrame:
    days = t.orders.select(as_date("o_orderdate").alias("order_date"))
    series = calendar_spine(daily_revenue(t), "order_date", "day", days)
    return _moving_average(series, "order_date", n)


def _costed_months(t: Tables, keys: tuple[str, ...], cost_ratio: Decimal) -> DataFrame:
    """Units, revenue, lines and cost per sale month and ``keys``: lines meet their orders, are summed
    per (product, month), and only those sums meet the product table."""
    months = order_dates(t).select("o_orderkey", month_start("order_date").alias("month"))
    measures = ["qty", "revenue", "n_lines"]
    lines = dated_lines(t, line_measures(t), measures, carry=("l_partkey",), orders=months)
    return costed(per_product(lines, ["month"], measures), t, [*keys, "month"], ["qty", "revenue"], cost_ratio)


def margin_trend(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Monthly units, revenue, cost, profit and margin, with the margin's change on the month
    before (on a gap-free calendar) and whether the month is complete.  A month without sales has
    zero sums and no margin; ``uncosted_lines`` counts lines of unknown products."""
    series = calendar_spine(_costed_months(t, (), cost_ratio), "month", "month", order_months(t))
    total = lambda c, kind: F.coalesce(F.col(c), F.lit(0)).cast(kind)
    series = series.select("month", total("qty", UNITS).alias("qty"), total("revenue", MONEY).alias("revenue"),
                           total("cost", MONEY).alias("cost"), total("uncosted_lines", "bigint").alias("uncosted_lines"))
    profit = (F.col("revenue") - F.col("cost")).cast(MONEY)
    margin = ratio(profit, F.col("revenue"))
    by_month = Window.orderBy("month")
    return series.select(
        "month", "qty", "revenue", "cost", "uncosted_lines", profit.alias("profit"), margin.alias("margin"),
        (margin - F.lag(margin, 1).over(by_month)).alias("margin_change"),
        (F.last_day("month") <= latest_order_date(t)).alias("is_complete"))


def margin_volume_corr(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Per category, the correlation across months between units sold and margin (rounded to
    6 places: the last digits of a correlation depend on the summation order).  Lines of unknown
    products have no category and no margin, so they are no row here."""
    monthly = _costed_months(t, ("category",), cost_ratio).where("category IS NOT NULL")
    margin = ratio(F.col("revenue") - F.col("cost"), F.col("revenue"))
    return monthly.groupBy("category").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_months"),
        F.round(F.corr(F.col("qty").cast("double"), margin), 6).alias("corr_qty_margin"))


def contribution_margin(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Per product: revenue minus variable cost (all cost counts as variable), per unit and as
    a share of revenue.  Unsold products appear with zeros and null ratios."""
    p = product_profit(t, cost_ratio)
    return p.select(
        "p_partkey", "p_name", "category", "qty", "revenue",
        F.col("cost").alias("variable_cost"),
        F.col("profit").alias("contribution_margin"),
        ratio(F.col("profit"), F.col("qty")).alias("cm_per_unit"),
        ratio(F.col("profit"), F.col("revenue")).alias("cm_ratio"))


def kpi_summary(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """One row of headline KPIs over all lines.  Lines are summed per product before they meet the
    product table (cost is linear in units, so product totals give the exact cost); lines of unknown
    products count everywhere but in ``cost`` and are reported as ``uncosted_lines``.  Order and buyer
    counts come from ``orders`` as scalar subqueries, so the row needs no join."""
    measures = ["qty", "revenue", "n_lines", "returned_lines"]
    products = product_costs(t, cost_ratio).select("p_partkey", "unit_cost")
    joined = attach(line_measures(t), products, "l_partkey", "p_partkey", measures)
    lines = joined.agg(
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.coalesce(F.sum(line_cost()), F.lit(0)).cast(MONEY).alias("cost"),
        F.sum("n_lines").cast("bigint").alias("n_lines"),
        F.sum(F.when(F.col("unit_cost").isNull(), F.col("n_lines")).otherwise(0)).cast("bigint").alias("uncosted_lines"),
        F.sum("returned_lines").cast("bigint").alias("returned_lines"))
    n_orders = t.orders.select(F.count(F.lit(1))).scalar()
    n_buyers = t.orders.select(F.count_distinct("o_custkey")).scalar()
    profit = (F.col("revenue") - F.col("cost")).cast(MONEY)
    return lines.select(
        "revenue", "cost", profit.alias("profit"), ratio(profit, F.col("revenue")).alias("margin"),
        n_orders.alias("n_orders"), n_buyers.alias("n_buyers"),
        ratio(F.col("revenue"), n_orders).alias("aov"),
        "n_lines", "uncosted_lines", ratio(F.col("returned_lines"), F.col("n_lines")).alias("return_rate"))
