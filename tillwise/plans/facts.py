"""Lean facts built per question, and the one join rule they all follow.

Catalyst does not drop an inner join whose columns are unused, so there is no wide shared
"sales" view: each question joins only the tables it needs, through :func:`attach`.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import as_date
from tillwise.functions.measures import (
    AMOUNT, DEFAULT_COST_RATIO, FACTOR_UNITS, MONEY, UNITS, exact, line_cost, line_qty, net_revenue,
    returned, unit_cost,
)
from tillwise.sources.tables import Tables


def attach(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           measures: Sequence[str], carry: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Join dimension ``dim`` to an additive ``fact`` on ``fact_key = dim_key``, one plan at every
    size: the fact is first summed to ``fact_key`` and ``carry``, then joined.

    Map-side partial aggregation shrinks the exchange to about one row per key per task, so a hot
    key collapses before it is shuffled; whether the dimension is broadcast is left to statistics
    and AQE.  Returns ``carry`` + ``measures`` + the dimension's columns for callers that finish
    with a ``groupBy(...).agg(sum(...))``; with ``how="left"`` facts without a match keep null
    dimension columns."""
    summed = fact.groupBy(fact_key, *carry).agg(*[F.sum(m).alias(m) for m in measures])
    return summed.join(dim, F.col(fact_key) == F.col(dim_key), how).drop(dim_key)


def order_dates(t: Tables) -> DataFrame:
    """One row per order: key, customer and sale date (the order date)."""
    return t.orders.select("o_orderkey", "o_custkey", as_date("o_orderdate").alias("order_date"))


def line_measures(t: Tables) -> DataFrame:
    """Line keys and additive measures, no dimension joined."""
    r = returned()
    revenue = net_revenue()
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        line_qty("l_quantity").alias("qty"),
        revenue.alias("revenue"),
        F.lit(1).cast("bigint").alias("n_lines"),
        F.when(r, 1).otherwise(0).cast("bigint").alias("returned_lines"),
        F.when(r, revenue).otherwise(F.lit(0).cast(AMOUNT)).alias("returned_revenue"),
    )


def dated_lines(t: Tables, lines: DataFrame, measures: Sequence[str],
                carry: Sequence[str] = (), orders: DataFrame | None = None) -> DataFrame:
    """Line measures with their order's customer and sale date (``orders`` may be a filtered
    :func:`order_dates`; lines of other orders drop out).

    Without ``carry`` lines are summed per order first.  With it (a product or supplier key) they
    are joined as they are, since few lines of an order share one; that join needs no exchange
    when both tables are bucketed by order key, and callers reduce its result before any other."""
    orders = order_dates(t) if orders is None else orders
    if not carry:
        return attach(lines, orders, "l_orderkey", "o_orderkey", measures, how="inner")
    lines = lines.select("l_orderkey", *carry, *measures)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")


def product_costs(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Product attributes used by profit questions: category and unit cost."""
    return t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"),
                         unit_cost(cost_ratio=cost_ratio).alias("unit_cost"))


def costed(totals: DataFrame, t: Tables, keys: Sequence[str], measures: Sequence[str],
           cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Totals per ``keys`` (category among them if named) of ``totals``, a frame already summed per
    product (``l_partkey``) and the other keys: measures, ``cost`` and ``uncosted_lines``.

    Products unknown to the product table stay: their category is null and their lines, whose
    cost cannot be known, are counted in ``uncosted_lines``."""
    products = product_costs(t, cost_ratio).select("p_partkey", "category", "unit_cost")
    joined = totals.join(products, totals.l_partkey == products.p_partkey, "left")
    return joined.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.coalesce(F.sum(line_cost()), F.lit(0)).cast(MONEY).alias("cost"),
        F.sum(F.when(F.col("unit_cost").isNull(), F.col("n_lines")).otherwise(0)).cast("bigint")
         .alias("uncosted_lines"))


def per_product(lines: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``lines`` summed per product and ``keys``: the reduction before the product join, so a hot
    product is one row per key and task when it is shuffled."""
    return lines.groupBy("l_partkey", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def product_categories(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_type").alias("category"))


def product_totals(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Units, revenue and line count per product (``l_partkey``), from lines alone; with
    ``orders`` (a frame of ``o_orderkey``) only lines of those orders (semi-join)."""
    lines = line_measures(t)
    if orders is not None:
        lines = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")),
                           "l_orderkey", "left_semi")
    return lines.groupBy("l_partkey").agg(
        F.sum("qty").cast(UNITS).alias("qty"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.sum("n_lines").alias("n_lines"),
    )


def product_profit(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO) -> DataFrame:
    """Every product with units, revenue, cost and profit; unsold products have zeros.

    Lines are totalled per product before the product table is joined (the result's grain),
    which is exact because cost is units times unit cost."""
    totals = product_totals(t)
    products = product_costs(t, cost_ratio)
    joined = products.join(totals, products.p_partkey == totals.l_partkey, "left")
    qty = F.coalesce(F.col("qty"), F.lit(0).cast(UNITS))
    revenue = F.coalesce(F.col("revenue"), F.lit(0).cast(MONEY))
    cost = F.coalesce(exact(qty, FACTOR_UNITS) * F.col("unit_cost"), F.lit(0)).cast(MONEY)
    return joined.select(
        "p_partkey", "p_name", "category",
        qty.alias("qty"), revenue.alias("revenue"), cost.alias("cost"),
        (revenue - cost).cast(MONEY).alias("profit"),
        F.coalesce(F.col("n_lines"), F.lit(0)).alias("n_lines"),
    )


def customer_profit(t: Tables, cost_ratio: Decimal = DEFAULT_COST_RATIO,
                    dates: bool = True) -> DataFrame:
    """Per customer with orders: revenue, cost, lines without a known cost and, with ``dates``, the
    number of orders (all rows of ``orders``, with or without lines) and the first order date.

    Lines meet their orders, are reduced to (product, customer) and only then meet the product
    table; order counts and dates come from ``orders`` alone.  Orders without a customer are one
    group with a null key."""
    customers = t.orders.select("o_orderkey", "o_custkey")
    lines = dated_lines(t, line_measures(t), ["qty", "revenue", "n_lines"], carry=("l_partkey",),
                        orders=customers)
    totals = per_product(lines, ["o_custkey"], ["qty", "revenue", "n_lines"])
    money = costed(totals, t, ["o_custkey"], ["revenue"], cost_ratio)
    if not dates:
        return money.select("o_custkey", F.col("revenue").cast(MONEY).alias("revenue"), "cost", "uncosted_lines")
    counts = order_dates(t).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("order_date").alias("first_order_date"))
    money = money.withColumnRenamed("o_custkey", "m_custkey")
    return counts.join(money, counts.o_custkey.eqNullSafe(money.m_custkey), "left").select(
        "o_custkey", "n_orders", F.coalesce(F.col("revenue"), F.lit(0)).cast(MONEY).alias("revenue"),
        F.coalesce(F.col("cost"), F.lit(0)).cast(MONEY).alias("cost"),
        F.coalesce(F.col("uncosted_lines"), F.lit(0)).cast("bigint").alias("uncosted_lines"), "first_order_date")
