"""Results kept up to date: partial sums per month, stored, and replaced month by month.

The store holds additive sums per month, customer region and category.  A newly arrived or corrected
month is recomputed alone and overwrites its own partition in one commit; totals of any kind are then
merged from the store, whose size follows months, regions and categories and not lines.  Running a
refresh twice changes nothing, and a refresh that fails leaves the months as they were.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import month_start
from tillwise.functions.measures import MONEY, UNITS
from tillwise.plans.facts import dated_lines, line_measures, order_dates, per_product, product_categories
from tillwise.plans.regions import orders_with_region
from tillwise.session import ensure_checkpoint_dir
from tillwise.sources.partitioned import since
from tillwise.sources.tables import Tables

SUMS = ["revenue", "qty", "n_lines"]
SCHEMA = f"region string, category string, revenue {MONEY}, qty {UNITS}, n_lines bigint, month date"


def month_sums(t: Tables, first: date | None = None, last: date | None = None) -> DataFrame:
    """The store's rows for the months from ``first`` to ``last`` (their first days, inclusive; none: all).

    On tables laid out by month only those months are read."""
    orders, lines = t.orders, t.lineitem
    if first is not None:
        orders, lines = since(orders, F.lit(first)), since(lines, F.lit(first))
    part = t.replace(orders=orders, lineitem=lines)
    tagged = orders_with_region(part, order_dates(part).withColumn("month", month_start("order_date")))
    if first is not None:
        tagged = tagged.where(F.col("month") >= F.lit(first))
    if last is not None:
        tagged = tagged.where(F.col("month") <= F.lit(last))
    dated = dated_lines(part, line_measures(part), SUMS, carry=("l_partkey",),
                        orders=tagged.select("o_orderkey", "month", "region"))
    products = product_categories(t)
    sums = per_product(dated, ["month", "region"], SUMS)
    return (sums.join(products, sums.l_partkey == products.p_partkey, "left")
            .groupBy("month", "region", "category").agg(*[F.sum(m).alias(m) for m in SUMS])
            .select("region", "category", F.col("revenue").cast(MONEY).alias("revenue"), F.col("qty").cast(UNITS).alias("qty"),
                    F.col("n_lines").cast("bigint").alias("n_lines"), "month"))


def refresh(t: Tables, folder: str, first: date | None = None, last: date | None = None) -> None:
    """Replace the stored sums of the months from ``first`` to ``last`` (none: from the first, to the
    last) by those of ``t``; other months stay.  A named month without a line any more is emptied."""
    rows = month_sums(t, first, last)
    if first is not None and last is not None:
        # A row without lines for each month, so that a month that lost all of its lines is replaced too.
        months = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("month")
        zero = t.spark.range(1).select(months).select(
            F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("category"),
            F.lit(0).cast(MONEY).alias("revenue"), F.lit(0).cast(UNITS).alias("qty"), F.lit(0).cast("bigint").alias("n_lines"), "month")
        rows = rows.unionByName(zero)
    (rows.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(folder))


def kept_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sums."""
    return spark.read.schema(SCHEMA).parquet(folder).where("n_lines > 0")


def period_totals(sums: DataFrame) -> DataFrame:
    """Revenue, units and lines by month, by year, by region and category, and over all, merged from
    stored sums: ``grain``, ``year``, ``month``, ``region``, ``category`` and the sums."""
    dated = sums.withColumn("year", F.year("month").cast("bigint"))
    by = [F.col(c) for c in ("year", "month", "region", "category")]
    grain = (F.when(F.grouping_id() == 0b0011, "month").when(F.grouping_id() == 0b0111, "year")
             .when(F.grouping_id() == 0b1100, "region_category").otherwise("all"))
    year, month, region, category = by
    return dated.groupingSets([[year, month], [year], [region, category], []], *by).agg(
        grain.alias("grain"), F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("qty").cast(UNITS).alias("qty"),
        F.sum("n_lines").cast("bigint").alias("n_lines")).where("n_lines > 0").select(
        "grain", "year", "month", "region", "category", "revenue", "qty", "n_lines")


def maintained_totals(t: Tables) -> DataFrame:
    """:func:`period_totals` of a store that is filled up to the month before the last, gets the last
    month when it arrives, and has the first month recomputed; equal to one run over everything."""
    folder = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/month-sums-{uuid.uuid4().hex}"
    first, last = order_dates(t).agg(F.trunc(F.min("order_date"), "month"), F.trunc(F.max("order_date"), "month")).first()
    if first is None:
        refresh(t, folder)
        return period_totals(kept_sums(t.spark, folder))
    before = date(last.year - (last.month == 1), (last.month - 2) % 12 + 1, 1)
    refresh(t, folder, None, before)
    refresh(t, folder, last, last)
    refresh(t, folder, first, first)
    refresh_undated(t, folder)
    return period_totals(kept_sums(t.spark, folder))


def refresh_undated(t: Tables, folder: str) -> None:
    """Replace the stored sums of orders without a date (the null month)."""
    undated = t.replace(orders=t.orders.where(F.col("o_orderdate").isNull()))
    refresh(undated, folder)

