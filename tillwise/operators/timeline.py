"""Questions over spans of days: trailing windows by time, the state of things as of a day, units under way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import as_date, day_diff
from tillwise.functions.measures import MONEY, UNITS, line_qty
from tillwise.operators.diagnostic import earliest_order_date, latest_order_date
from tillwise.plans.asof import asof_join
from tillwise.plans.events import every_day, merged_presence, running_levels, span_events
from tillwise.plans.facts import dated_lines, line_measures, order_dates
from tillwise.plans.intervals import overlap_join
from tillwise.plans.lookups import customer_regions
from tillwise.plans.regions import to_regions
from tillwise.sources.tables import Tables


def rolling_region_sales(t: Tables, days: int = 90) -> DataFrame:
    """Per customer region and calendar day: revenue of the last ``days`` days (the day included) and how
    many distinct customers ordered in them.

    Interval frames, by entry and exit: a day's revenue enters on its day and leaves ``days`` later; a
    customer enters with an order after none for ``days`` days and leaves when the next comes too late.
    Lines reduce to (customer, day) and (region, day) first; regions without an order have no rows, days
    without one do.  Orders without a known customer count under a null region, and not as customers."""
    first, last = earliest_order_date(t), latest_order_date(t)
    daily = dated_lines(t, line_measures(t), ["revenue"]).groupBy("o_custkey", "order_date").agg(F.sum("revenue").alias("revenue"))
    daily = to_regions(daily, t, ["revenue"], ["order_date"])
    money = span_events(daily.withColumn("end", F.date_add("order_date", days)), ["region"], "order_date", "end", ["revenue"])

    visits = order_dates(t).where(F.col("o_custkey").isNotNull()).select("o_custkey", "order_date").distinct()
    edges = merged_presence(visits, ["o_custkey"], "order_date", days)
    moves = (span_events(edges.withColumn("n", F.lit(1).cast("bigint")), ["o_custkey"], "start", "end", ["n"]))
    people = to_regions(moves, t, ["n"], ["day"])
    zero_money, zero = F.lit(0).cast(MONEY), F.lit(0).cast("bigint")
    both = (money.select("region", "day", F.col("revenue").cast(MONEY).alias("revenue"), zero.alias("customers"))
            .unionByName(people.select("region", "day", zero_money.alias("revenue"), F.col("n").cast("bigint").alias("customers")))
            .groupBy("region", "day").agg(F.sum("revenue").alias("revenue"), F.sum("customers").alias("customers")))
    levels = every_day(both, ["region"], ["revenue", "customers"], first, last)
    return levels.select("region", F.col("day").alias("order_date"), F.col("revenue").cast(MONEY).alias("rolling_revenue"),
                         F.col("customers").cast("bigint").alias("active_customers"))


def last_shipment_price(t: Tables) -> DataFrame:
    """Each line with the unit price at which its product was last shipped before the line's order date:
    the shipment's day, its price, and the days since; null for a product not shipped before, or not known.  Of a day's
    shipments of a product the one with the greatest (order, line number, price, quantity) counts."""
    lines = dated_lines(t, t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), [],
                        carry=("l_linenumber", "l_partkey"), orders=order_dates(t).select("o_orderkey", "order_date"))
    latest = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    shipped = (t.lineitem.where(F.col("l_partkey").isNotNull()).select("l_partkey", as_date("l_shipdate").alias("last_ship_date"), latest.alias("s"))
               .groupBy("l_partkey", "last_ship_date").agg(F.max("s").alias("s")))
    price = F.try_divide(F.col("s.l_extendedprice"), F.col("s.l_quantity")).alias("last_unit_price")
    found = asof_join(lines, shipped.select("l_partkey", "last_ship_date", price), ["l_partkey"], "order_date",
                      "last_ship_date", ["last_unit_price"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "order_date", "last_ship_date", "last_unit_price",
                        day_diff("order_date", "last_ship_date").alias("days_since_shipment"))


def _transit_lines(t: Tables) -> DataFrame:
    """Lines of a known order with their product, units and span from order to shipment (exclusive)."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", line_qty("l_quantity").alias("qty"),
                              as_date("l_shipdate").alias("ship_date"))
    return dated_lines(t, lines, ["qty"], carry=("l_partkey", "ship_date"),
                       orders=order_dates(t).select("o_orderkey", "order_date")).where("order_date < ship_date")


def units_in_transit(t: Tables) -> DataFrame:
    """Per product the units ordered and not yet shipped, as a step function: ``units`` from
    ``from_date`` until before ``to_date``.  Lines shipped on or before their order date are never under
    way.  Lines reduce to one event per product and day; no line is expanded into its days."""
    events = span_events(_transit_lines(t), ["l_partkey"], "order_date", "ship_date", ["qty"])
    levels = running_levels(events, ["l_partkey"], ["qty"])
    to = F.lead("day").over(Window.partitionBy("l_partkey").orderBy("day"))
    return (levels.select("l_partkey", F.col("day").alias("from_date"), to.alias("to_date"), F.col("qty").cast(UNITS).alias("units"))
            .where(F.col("to_date").isNotNull()))


def transit_peaks(t: Tables) -> DataFrame:
    """Per product its peak of units under way: ``peak_units``, the first days it held, and the lines
    and distinct orders that were under way then (an interval join of lines with the peaks; their units
    add up to the peak)."""
    steps = units_in_transit(t).where(F.col("l_partkey").isNotNull())
    best = steps.groupBy("l_partkey").agg(F.max(F.struct("units", F.datediff(F.lit("1970-01-01").cast("date"), "from_date").alias("early"),
                                                         "from_date", "to_date")).alias("p"))
    peaks = best.select("l_partkey", "p.units", "p.from_date", "p.to_date")
    lines = _transit_lines(t).select("l_orderkey", "l_partkey", "qty", "order_date", "ship_date")
    # One peak per product: buckets would only multiply the lines, each by the length of its span.
    pairs = overlap_join(lines, peaks, ["l_partkey"], ("order_date", "ship_date"), ("from_date", "to_date"), bucket_days=None)
    per_order = pairs.groupBy("l_partkey", "units", "from_date", "to_date", "l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))
    return per_order.groupBy("l_partkey", F.col("units").alias("peak_units"), "from_date", "to_date").agg(
        F.sum("n").cast("bigint").alias("n_lines"), F.count(F.lit(1)).alias("n_orders"),
        F.sum("qty").cast(UNITS).alias("line_units"))
