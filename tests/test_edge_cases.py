"""Hand-made edge cases X1-X10 (FIXTURES.md §4).  The driver's tables cannot fail these
mistakes: they have no gaps, no unsold product, almost no one-time buyer and no nulls.

Each case asserts hand-computed values and also compares the whole result with the oracle SQL
run by DuckDB on the same Parquet files."""

import datetime as dt
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from tests.fixtures import Builder, duck_on
from tests.oracle_compare import compare
from tillwise.catalog import QUERIES
from tillwise.operators import descriptive, diagnostic, strategic


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def shop(spark):
    """Four customers (one never ordered), three products (one never sold), March 2000 without
    any order, two orders of one customer on one day, a customer first seen in the last
    month."""
    b = Builder()
    b.customer(1, nation=0).customer(2, nation=5).customer(3, nation=10).customer(4, nation=15)
    b.part(10, price=100.0).part(11, price=100.0, ptype="PROMO").part(12, price=50.0, ptype="PROMO")
    b.order(1, 1, "2000-01-10").line(1, 10, 1, 100.0)
    b.order(2, 1, "2000-02-15").line(2, 10, 2, 200.0)
    b.order(3, 1, "2000-02-15").line(3, 11, 1, 50.0)
    b.order(4, 2, "2000-04-01").line(4, 11, 3, 300.0, discount=0.1)
    b.order(5, 3, "2000-04-20").line(5, 10, 1, 80.0, flag="R")
    folder, tables = b.write(spark)
    return tables, duck_on(folder)


SHOP_QUERIES = ["revenue_by_period", "revenue_growth", "moving_avg_month", "moving_avg_day",
                "purchase_gaps", "avg_purchase_gap", "repeat_rate_by_region", "customer_ltv",
                "unsold_products", "quantity_per_product", "top_products", "returns_by_month",
                "customer_rank_family", "kpi_summary", "contribution_margin", "margin_trend",
                "slow_movers", "pareto_customers", "stock_movement_monthly", "revenue_cube"]


@pytest.mark.parametrize("name", SHOP_QUERIES)
def test_shop_matches_oracle(shop, name):
    tables, con = shop
    res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
    assert res.get("ok"), res


def test_x1_x4_month_gap_and_zero_base(shop):
    tables, _ = shop
    g = rows_by(diagnostic.revenue_growth(tables), "month")
    assert len(g) == 4                                   # March filled in by the spine
    march, april = g[dt.date(2000, 3, 1)], g[dt.date(2000, 4, 1)]
    assert march["revenue"] == 0 and march["mom_growth"] == -1.0
    assert april["prev_month_revenue"] == 0 and april["mom_growth"] is None   # zero base: null
    assert g[dt.date(2000, 2, 1)]["mom_growth"] == 1.5
    assert [g[m]["is_complete"] for m in sorted(g)] == [True, True, True, False]
    ma = rows_by(strategic.moving_avg_month(tables), "month")
    assert ma[dt.date(2000, 1, 1)]["frame_rows"] == 1
    assert ma[dt.date(2000, 2, 1)]["moving_avg"] == 175.0
    assert ma[dt.date(2000, 4, 1)]["moving_avg"] == 200.0       # (250 + 0 + 350) / 3


def test_x2_x3_gaps_one_order_customer_and_same_day(shop):
    tables, _ = shop
    gaps = rows_by(diagnostic.purchase_gaps(tables), "o_orderkey")
    assert gaps[1]["prev_order_date"] is None and gaps[1]["gap_days"] is None
    assert gaps[2]["gap_days"] == 36
    assert gaps[3]["prev_order_date"] == dt.date(2000, 2, 15) and gaps[3]["gap_days"] == 0
    assert gaps[5]["gap_days"] is None
    avg = rows_by(diagnostic.avg_purchase_gap(tables), "o_custkey")
    assert avg[1]["avg_gap_days"] == 18.0 and avg[3]["avg_gap_days"] is None
    rate = rows_by(diagnostic.repeat_rate_by_region(tables), "region")
    assert rate["AFRICA"]["repeat_rate"] == 1.0 and rate["ASIA"]["repeat_rate"] == 0.0
    ltv = rows_by(strategic.customer_ltv(tables), "o_custkey")
    assert ltv[1]["profit"] == Decimal("110.0000")      # 350 revenue - 4 units x 60
    assert ltv[3]["tenure_days"] == 0 and ltv[3]["projected_ltv"] is None
    short = rows_by(strategic.customer_ltv(tables, min_tenure_days=0), "o_custkey")
    assert short[3]["projected_ltv"] is None            # zero tenure: no division error
    assert short[1]["projected_ltv"] == pytest.approx(110 / 101 * 365.25 * 3)


def test_x6_product_never_sold(shop):
    tables, _ = shop
    qty = rows_by(descriptive.quantity_per_product(tables), "p_partkey")
    assert qty[12]["total_qty"] == 0 and qty[12]["n_lines"] == 0
    assert [r.p_partkey for r in diagnostic.unsold_products(tables).collect()] == [12]
    slow = rows_by(diagnostic.slow_movers(tables), "p_partkey")
    assert slow[12]["recent_qty"] == 0 and slow[12]["is_slow"]
    cm = rows_by(strategic.contribution_margin(tables), "p_partkey")
    assert cm[12]["cm_ratio"] is None and cm[12]["cm_per_unit"] is None


def test_rank_family_with_ties(shop):
    tables, _ = shop
    fam = rows_by(descriptive.customer_rank_family(tables), "c_custkey")
    c = (1, 2, 3, 4)                                     # 3, 1, 1 and 0 orders
    assert [fam[k]["n_orders"] for k in c] == [3, 1, 1, 0]
    assert [fam[k]["row_num"] for k in c] == [1, 2, 3, 4]
    assert [fam[k]["rank_num"] for k in c] == [1, 2, 2, 4]
    assert [fam[k]["dense_rank_num"] for k in c] == [1, 2, 2, 3]
    assert [fam[k]["ntile_num"] for k in c] == [1, 2, 3, 4]
    assert [fam[k]["pct_rank"] for k in c] == [0.0, 1 / 3, 1 / 3, 1.0]
    assert [fam[k]["cume_dist"] for k in c] == [0.25, 0.75, 0.75, 1.0]
    pareto = rows_by(strategic.pareto_customers(tables), "c_custkey")
    assert pareto[4]["profit"] == 0 and pareto[4]["profit_rank"] == 4


@pytest.fixture(scope="module")
def ties(spark):
    """Seven products, one line each, profits 50, 30, 30, 0, 0, -10, -20 (unit cost 60):
    ties at the cut, zero and negative profit, N = 7 not divisible by 5."""
    b = Builder().customer(1)
    prices = [110.0, 90.0, 90.0, 60.0, 60.0, 50.0, 40.0]
    for i, price in enumerate(prices):
        key = 20 + i
        b.part(key, price=100.0).order(100 + i, 1, "1999-06-01").line(100 + i, key, 1, price)
    folder, tables = b.write(spark)
    return tables, duck_on(folder)


@pytest.mark.parametrize("name", ["pareto_products", "top_products", "slow_movers",
                                  "contribution_margin", "underperformers"])
def test_ties_match_oracle(ties, name):
    tables, con = ties
    res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
    assert res.get("ok"), res


def test_x5_x9_x10_pareto_ties_negatives_remainder(ties):
    tables, _ = ties
    p = sorted(strategic.pareto_products(tables).collect(), key=lambda r: r.profit_rank)
    assert [r.p_partkey for r in p] == [20, 21, 22, 23, 24, 25, 26]    # ties by key
    assert [r.cum_profit for r in p] == [Decimal(x) for x in
                                         ("50", "80", "110", "110", "110", "100", "80")]
    assert max(r.cum_share for r in p) == 1.375 and p[-1].cum_share == 1.0
    assert [r.is_top for r in p] == [True, True] + [False] * 5       # ceil(0.2 * 7) = 2
    top = descriptive.top_products(tables, k=2).collect()
    assert sorted(r.p_partkey for r in top) == [20, 21, 22]          # rank() keeps the tie
    slow = rows_by(diagnostic.slow_movers(tables), "p_partkey")
    assert sorted(v["quartile"] for v in slow.values()) == [1, 1, 2, 2, 3, 3, 4]


def test_x7_real_null_region_is_not_a_subtotal(spark):
    b = Builder()
    b.rows["region"][4] = (4, None)                       # nations 20-24 have no region name
    b.customer(1, nation=0).customer(2, nation=20).part(1)
    b.order(1, 1, "2000-01-01").line(1, 1, 1, 10.0).order(2, 2, "2000-01-02").line(2, 1, 1, 5.0)
    folder, tables = b.write(spark)
    cube = descriptive.revenue_cube(tables).collect()
    null_region = [r for r in cube if r.region is None and r.category is not None]
    assert sorted((r.g_region, r.revenue) for r in null_region) == [
        (0, Decimal("5.0000")), (1, Decimal("15.0000"))]
    res = compare(descriptive.revenue_cube(tables), duck_on(folder),
                  entry.oracle_sql()["revenue_cube"])
    assert res.get("ok"), res


def test_x8_incomplete_last_year(spark):
    b = Builder().customer(1).part(1, ptype="PROMO").part(2, ptype="SMALL")
    b.order(0, 1, "1998-01-05")                            # 1998 is there from its January on
    b.order(1, 1, "1998-03-01").line(1, 1, 1, 100.0).line(1, 2, 1, 100.0)
    b.order(2, 1, "1999-03-01").line(2, 1, 1, 150.0).line(2, 2, 1, 50.0)
    b.order(3, 1, "2000-02-01").line(3, 1, 1, 999.0)      # 2000 is incomplete: ignored
    folder, tables = b.write(spark)
    g = rows_by(diagnostic.growth_ranking(tables, ("category",)), "category")
    assert g["PROMO"]["prev_year"] == 1998 and g["PROMO"]["cur_year"] == 1999
    assert g["PROMO"]["growth"] == 0.5 and g["PROMO"]["growth_rank"] == 1
    assert g["SMALL"]["growth"] == -0.5 and g["SMALL"]["growth_rank"] == 2
    con = duck_on(folder)
    for name in ("category_growth", "region_growth", "category_region_growth"):
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
        assert res.get("ok"), (name, res)


@pytest.mark.parametrize("name", ["pareto_products", "slow_movers", "pareto_customers"])
def test_ties_match_oracle_on_many_slices(spark, ties, name):
    """Ties, zero and negative profits with slices of a row or two (AQE must not merge them), so tie
    groups straddle slice borders."""
    tables, con = ties
    settings = {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert res.get("ok"), res


UNIT_QUERIES = ["quantity_per_product", "stock_movement_monthly", "slow_movers", "contribution_margin",
                "pareto_products", "kpi_summary", "margin_trend", "customer_ltv"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_and_fractional_units_are_exact(spark, ansi):
    b = Builder().customer(1).part(1).part(2, price=3.0)
    b.order(1, 1, "2000-01-10").line(1, 1, 1_000_000, 100.0).line(1, 2, 2.125, 10.0)
    folder, tables = b.write(spark)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        qty = rows_by(descriptive.quantity_per_product(tables), "p_partkey")
        assert qty[1]["total_qty"] == 1_000_000 and qty[2]["total_qty"] == Decimal("2.1250")
        con = duck_on(folder)
        for name in UNIT_QUERIES:
            res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
            assert res.get("ok"), (name, res)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_units_that_do_not_fit_fail(spark, ansi):
    b = Builder().customer(1).part(1).order(1, 1, "2000-01-10").line(1, 1, 1e15, 100.0)
    _, tables = b.write(spark)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            descriptive.quantity_per_product(tables).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_orders_without_customer_keep_their_gaps(spark):
    b = Builder().customer(1)
    b.order(1, 1, "2000-01-01").order(2, 1, "2000-01-11").order(3, None, "2000-01-05").order(4, None, "2000-01-06")
    folder, tables = b.write(spark)
    con = duck_on(folder)
    assert diagnostic.purchase_gaps(tables).count() == 4
    for name in ("purchase_gaps", "purchase_gap_summary"):
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
        assert res.get("ok"), (name, res)
    every = [r for r in diagnostic.purchase_gap_summary(tables).collect() if r.scope == "all"]
    assert [(r.n_gaps, r.avg_gap_days, r.median_gap_days) for r in every] == [(1, 10.0, 10.0)]


def test_gap_median_of_even_counts_and_regions(spark):
    b = Builder().customer(1, nation=0).customer(2, nation=5).customer(3, nation=99)
    for i, day in enumerate(["01", "02", "05", "15", "16"]):
        b.order(10 + i, 1, f"2000-01-{day}")
    b.order(20, 2, "2000-02-01").order(21, 2, "2000-02-01").order(30, 3, "2000-02-01").order(31, 3, "2000-02-08")
    folder, tables = b.write(spark)
    res = compare(QUERIES["purchase_gap_summary"](tables), duck_on(folder), entry.oracle_sql()["purchase_gap_summary"])
    assert res.get("ok"), res
    got = {(r.scope, r.region): r.median_gap_days for r in diagnostic.purchase_gap_summary(tables).collect()}
    assert got == {("all", None): 2.0, ("region", "AFRICA"): 2.0, ("region", "AMERICA"): 0.0, ("region", None): 7.0}


GROWTH = ("category_growth", "region_growth", "category_region_growth", "supplier_region_growth")


@pytest.mark.parametrize("dates, years", [
    (["1999-12-01", "2000-03-01", "2000-12-31"], None),                 # one complete year only
    (["1999-02-01", "2000-03-01", "2001-12-01"], (2000, 2001)),         # partial first year
    (["1999-01-20", "1999-06-01", "2000-12-30"], (1999, 2000)),         # ends on 30 December
    (["1998-01-01", "1999-05-01", "2000-11-30"], (1998, 1999)),         # last year without December
])
def test_growth_compares_complete_years_only(spark, dates, years):
    b = Builder().customer(1).part(1)
    for i, date in enumerate(dates):
        b.order(i, 1, date).line(i, 1, 1, 100.0 + i)
    folder, tables = b.write(spark)
    con = duck_on(folder)
    for name in GROWTH:
        rows = QUERIES[name](tables).collect()
        assert {(r.prev_year, r.cur_year) for r in rows} == ({years} if years else set()), name
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
        assert res.get("ok"), (name, res)


def test_orphan_and_null_products_stay_in_totals(spark):
    b = Builder().customer(1, nation=0).part(1)
    b.order(1, 1, "2000-01-10").line(1, 1, 1, 100.0).line(1, 77, 2, 100.0).line(1, None, 1, 50.0)
    b.order(2, 9, "2001-01-10").line(2, 77, 1, 10.0)                    # customer 9 is unknown too
    folder, tables = b.write(spark)
    con = duck_on(folder)
    for name in ("kpi_summary", "revenue_cube", "category_growth", "category_region_growth", "margin_trend",
                 "margin_volume_corr", "customer_ltv", "pareto_customers", "revenue_by_period", "region_growth"):
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
        assert res.get("ok"), (name, res)
    kpi = strategic.kpi_summary(tables).first()
    years = [r.revenue for r in descriptive.revenue_by_period(tables).collect() if r.grain == "year"]
    grand = [r.revenue for r in descriptive.revenue_cube(tables).collect() if r.g_region and r.g_category]
    customers = [r.revenue for r in strategic.customer_ltv(tables).collect()]
    assert kpi.revenue == sum(years) == grand[0] == sum(customers) == Decimal("260.0000")
    assert (kpi.n_lines, kpi.uncosted_lines, kpi.cost) == (4, 3, Decimal("60.0000"))


def test_gap_month_agrees_between_margin_and_growth(shop):
    tables, _ = shop
    margin = rows_by(strategic.margin_trend(tables), "month")[dt.date(2000, 3, 1)]
    growth = rows_by(diagnostic.revenue_growth(tables), "month")[dt.date(2000, 3, 1)]
    assert margin["revenue"] == growth["revenue"] == 0 and margin["qty"] == 0 and margin["margin"] is None


def test_hot_product(spark):
    """A product with a third of the lines gives the oracle's results on the reduced joins."""
    b = Builder().customer(1, nation=0).customer(2, nation=7)
    for p in range(1, 9):
        b.part(p, price=10.0 * p, ptype="PROMO" if p % 2 else "SMALL")
    for o in range(60):
        b.order(o, 1 + o % 2, f"{1999 + o % 2}-{1 + o % 12:02d}-05").line(o, 1, 1 + o % 3, 20.0).line(
            o, 2 + o % 7, 1, 30.0).line(o, 2 + (o + 3) % 7, 2, 15.0)
    folder, tables = b.write(spark)
    con = duck_on(folder)
    for name in ("margin_trend", "margin_volume_corr", "category_growth", "category_region_growth",
                 "revenue_cube", "customer_ltv", "pareto_customers", "pareto_products"):
        res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
        assert res.get("ok"), (name, res)


def test_a_wide_tie_is_whole_and_spread(spark):
    """200,000 customers with one order each, one with two: all ties come back, and the rows of the
    result lie in several partitions."""
    from pyspark.sql import functions as F
    counts = spark.range(200_000).select(F.col("id").alias("key"), F.lit(1).cast("bigint").alias("n"))
    counts = counts.union(spark.createDataFrame([(-1, 2)], "key bigint, n bigint")).repartition(8)
    top = descriptive.top_rank(counts, "n", 10, "r")
    by_rank = {r["r"]: r["count"] for r in top.groupBy("r").count().collect()}
    assert by_rank == {1: 1, 2: 200_000}
    sizes = [r["count"] for r in top.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 100_000


def test_sliced_order_files_follow_the_data(spark):
    """2,000 rows at 500 shuffle partitions: a few checkpoint files, positions in order."""
    from pyspark.sql import functions as F
    from tillwise.plans.ordering import global_order, ordered_slices
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        df = spark.range(2000).select("id", (F.col("id") * 7919 % 97).alias("v"))
        order = [F.col("v").desc(), F.col("id").asc()]
        assert ordered_slices(df, order).rdd.getNumPartitions() <= 8
        rows = global_order(df, order).collect()
        assert [r.position for r in sorted(rows, key=lambda r: (-r.v, r.id))] == list(range(1, 2001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_family_with_a_hot_value(spark):
    """A value held by most rows, over several slices, against Spark's own window functions."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tillwise.plans.ordering import rank_family
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.col("id") % 11).otherwise(5).alias("v"))
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ours = {tuple(r) for r in rank_family(df, "v", "k").select("k", "v", "row_number", "rank", "dense_rank", "ntile").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    by, place = Window.orderBy(F.desc("v")), Window.orderBy(F.desc("v"), "k")
    plain = df.select("k", "v", F.row_number().over(place), F.rank().over(by), F.dense_rank().over(by), F.ntile(4).over(place))
    assert ours == {tuple(r) for r in plain.collect()}
