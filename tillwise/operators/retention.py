"""Who comes back: cohorts and the change of the customer base between periods, from month bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import first_complete_year, last_complete_year
from tillwise.functions.ratios import ratio
from tillwise.operators.diagnostic import earliest_order_date, latest_order_date
from tillwise.plans.facts import order_dates
from tillwise.plans.periods import active_months, first_month, month_of, months_between, months_in
from tillwise.plans.regions import to_regions
from tillwise.sources.tables import Tables


def customer_months(t: Tables) -> DataFrame:
    """The months in which each known customer ordered, as bitmaps."""
    return active_months(order_dates(t).where(F.col("o_custkey").isNotNull()), "o_custkey", "order_date")


def cohort_retention(t: Tables) -> DataFrame:
    """Cohorts by month of the first order: for each month since in which one of them ordered, how many
    did, and their share of the cohort.

    Customers with one history (first month and bitmap) are counted together before the history is
    spread over its months."""
    words = customer_months(t)
    histories = words.groupBy("o_custkey").agg(
        F.min(first_month(F.col("word"), F.col("bits"))).alias("cohort"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))   # a few words each
    alike = histories.groupBy("cohort", "words").agg(F.count(F.lit(1)).alias("n"))
    spread = (alike.select("cohort", "n", F.inline("words"))
              .select("cohort", "n", F.explode(months_in(F.col("word"), F.col("bits"))).alias("month")))
    cells = spread.groupBy("cohort", "month").agg(F.sum("n").alias("n"))
    sizes = cells.where("month = cohort").select(F.col("cohort").alias("of"), F.col("n").alias("size"))
    return cells.join(sizes, cells.cohort == sizes["of"]).select(
        month_of(F.col("cohort")).alias("cohort_month"), (F.col("month") - F.col("cohort")).alias("months_since"),
        F.col("size").cast("bigint").alias("cohort_size"), F.col("n").cast("bigint").alias("active"),
        ratio(F.col("n"), F.col("size")).alias("retention"))


def period_changes(t: Tables, first: tuple[Column, Column] | None = None, second: tuple[Column, Column] | None = None
                   ) -> DataFrame:
    """Per customer region, between two periods of months: customers who ordered in both (``kept``), only
    in the first (``lost``), only in the second without any earlier order (``new``) and with one
    (``returned``).  A period is a pair of month numbers (:func:`month_number`), the second exclusive;
    the default is the last two complete years."""
    year = last_complete_year(latest_order_date(t))
    whole = first is None and second is None
    first = first or ((year - 1) * 12, year * 12)
    second = second or (year * 12, (year + 1) * 12)
    words = customer_months(t)
    word, bits = F.col("word"), F.col("bits")

    def any_in(low: Column, after: Column) -> Column:
        return F.max(bits.bitwiseAND(months_between(word, low, after)) != 0)

    seen = words.groupBy("o_custkey").agg(
        any_in(*first).alias("a"), any_in(*second).alias("b"),
        F.max(bits.bitwiseAND(months_between(word, F.lit(0), second[0])) != 0).alias("before"))
    if whole:
        seen = seen.where(year - 1 >= first_complete_year(earliest_order_date(t)))
    flag = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    a, b, before = F.col("a"), F.col("b"), F.col("before")
    names = ["kept", "lost", "new", "returned"]
    flags = seen.where(a | b).select("o_custkey", flag(a & b).alias("kept"), flag(a & ~b).alias("lost"),
                                     flag(~before & b).alias("new"), flag(~a & b & before).alias("returned"))
    return to_regions(flags, t, names).select(
        "region", *[F.col(n).cast("bigint").alias(n) for n in names],
        ratio(F.col("kept"), F.col("kept") + F.col("lost")).alias("kept_share"))
