"""Level, slope and month effects of monthly revenue, and what they say about the next months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.measures import MONEY
from tillwise.operators.diagnostic import latest_order_date
from tillwise.plans.facts import dated_lines, line_measures, order_dates, per_product, product_categories
from tillwise.plans.periods import month_number, month_of
from tillwise.sources.tables import Tables


def category_months(t: Tables) -> DataFrame:
    """Revenue of each category (null: unknown product) in each month from the first order on to the
    last month that the data cover to its end; months without a sale are zero.  ``at`` counts the months
    from 0, ``season`` is the month of the year.  One row per category and calendar month."""
    orders = order_dates(t).select("o_orderkey", month_number(F.col("order_date")).alias("month"))
    lines = dated_lines(t, line_measures(t), ["revenue"], carry=("l_partkey",), orders=orders)
    sums = per_product(lines, ["month"], ["revenue"])
    products = product_categories(t)
    found = (sums.join(products, sums.l_partkey == products.p_partkey, "left").groupBy("category", "month")
             .agg(F.sum("revenue").cast(MONEY).alias("revenue")))
    first = t.orders.select(F.min(month_number(F.to_date("o_orderdate")))).scalar()
    latest = latest_order_date(t)
    last = month_number(latest) - F.when(latest < F.last_day(latest), 1).otherwise(0)
    spans = found.select("category").distinct().where(last >= first).select(
        "category", F.explode(F.sequence(first, last)).alias("month"), first.alias("start"))
    other = found.select(F.col("category").alias("c"), F.col("month").alias("m"), "revenue")
    return spans.join(other, spans.category.eqNullSafe(F.col("c")) & (spans.month == F.col("m")), "left").select(
        "category", "month", (F.col("month") - F.col("start")).alias("at"), F.pmod("month", F.lit(12)).alias("season"),
        F.coalesce("revenue", F.lit(0)).cast(MONEY).alias("revenue"))


def season_moments(series: DataFrame) -> DataFrame:
    """The moments of ``series`` per category and month of the year: count and sums of time, revenue, time
    squared and time by revenue.  They are exact and additive, so stored moments of old months and those of
    a new one are merged by summing."""
    at, revenue = F.col("at"), F.col("revenue").cast("decimal(32,4)")
    return series.groupBy("category", "season").agg(
        F.count(F.lit(1)).alias("n"), F.sum("at").alias("t"), F.sum(revenue).alias("y"), F.sum(at * at).alias("tt"),
        F.sum(at.cast("decimal(6,0)") * F.col("revenue").cast("decimal(30,4)")).alias("ty"))


def fit(moments: DataFrame) -> DataFrame:
    """Least squares of revenue on a level per month of the year and one slope: ``slope`` and ``level`` per
    category and season.  The seasons' own means are taken out of time and revenue, the slope follows from
    what is left, and each level from its means.  The slope is 0 if no season was seen twice."""
    n, t, y, tt, ty = (F.col(c).cast("double") for c in ("n", "t", "y", "tt", "ty"))
    category = Window.partitionBy("category")   # at most 12 rows
    slope = F.coalesce(F.try_divide(F.sum(ty - t * y / n).over(category), F.sum(tt - t * t / n).over(category)), F.lit(0.0))
    return moments.select("category", "season", slope.alias("slope"), "n", t.alias("t"), y.alias("y")).select(
        "category", "season", "slope", ((F.col("y") - F.col("slope") * F.col("t")) / F.col("n")).alias("level"))


def category_forecast(t: Tables, months: int = 3) -> DataFrame:
    """Per category the revenue forecast of the next ``months`` months, with the fitted monthly slope and the
    root mean square error over the months fitted.  A season never seen has the mean level of the others."""
    series = category_months(t)
    model = fit(season_moments(series))
    names = model.select(F.col("category").alias("c"), F.col("season").alias("s"), "slope", "level")
    fitted = series.join(names, series.category.eqNullSafe(F.col("c")) & (series.season == F.col("s")))
    off = F.col("revenue").cast("double") - F.col("level") - F.col("slope") * F.col("at")
    quality = fitted.groupBy("category").agg(
        F.sqrt(F.avg(off * off)).alias("rmse"), F.count(F.lit(1)).alias("n_months"), F.max("month").alias("last"),
        F.max("at").alias("last_at"), F.max("slope").alias("slope"))
    mean = model.groupBy(F.col("category").alias("k")).agg(F.avg("level").alias("mean_level"))
    ahead = quality.select("*", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("ahead")).withColumn(
        "season", F.pmod(F.col("last") + F.col("ahead"), F.lit(12)))
    levels = model.select(F.col("category").alias("c"), F.col("season").alias("s"), "level")
    joined = (ahead.join(levels, ahead.category.eqNullSafe(F.col("c")) & (ahead.season == F.col("s")), "left")
              .join(mean, ahead.category.eqNullSafe(F.col("k"))))
    value = F.coalesce("level", "mean_level") + F.col("slope") * (F.col("last_at") + F.col("ahead"))
    return joined.select("category", month_of(F.col("last") + F.col("ahead")).alias("month"),
                         F.round(value, 2).alias("forecast"), F.round("slope", 2).alias("monthly_slope"),
                         F.round("rmse", 2).alias("rmse"), F.col("n_months").cast("bigint").alias("n_months"))
