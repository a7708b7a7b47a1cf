"""Regions: rolling customer- and supplier-level measures up, or tagging orders with a region.

Joins to customers and suppliers are left joins: a row whose customer, supplier or nation is unknown
stays, under a null region, so regional totals add up to the total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.plans.facts import attach, order_dates
from tillwise.plans.lookups import customer_regions, nation_regions
from tillwise.sources.tables import Tables


def to_regions(fact: DataFrame, t: Tables, measures: Sequence[str],
               keys: Sequence[str] = ()) -> DataFrame:
    """Sum additive ``measures`` of rows keyed ``o_custkey`` (+ ``keys``) per customer region."""
    tagged = attach(fact, customer_regions(t), "o_custkey", "c_custkey", measures, keys)
    return tagged.groupBy("region", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def orders_with_region(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """:func:`order_dates` rows (or a filtered frame of them) tagged with the customer's region.

    For line facts that carry a second key (a product), tagging the orders first costs one
    orders-sized join, and the lines then need a single join to reach the region instead of
    one to orders and another, still at line grain, to customers."""
    orders = order_dates(t) if orders is None else orders
    regions = customer_regions(t)
    return orders.join(regions, orders.o_custkey == regions.c_custkey, "left").drop("c_custkey")


def supplier_regions(fact: DataFrame, t: Tables, measures: Sequence[str]) -> DataFrame:
    """Sum additive ``measures`` of rows keyed ``l_suppkey`` per supplier region."""
    nations = nation_regions(t)
    suppliers = t.supplier.select("s_suppkey", "s_nationkey")
    suppliers = (suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "left")
                 .select("s_suppkey", "region"))
    tagged = attach(fact, suppliers, "l_suppkey", "s_suppkey", measures)
    return tagged.groupBy("region").agg(*[F.sum(m).alias(m) for m in measures])
