"""Interval frames, as-of and interval joins, month bitmaps and forecasts: against brute force on
random rows, and every question against its SQL on a shop with unknown keys, gaps and ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.fixtures import Builder, duck_on
from tests.oracle_compare import compare
from tillwise.catalog import QUERIES
from tillwise.operators import forecast, retention
from tillwise.plans.asof import asof_join
from tillwise.plans.events import every_day, merged_presence, running_levels, span_events
from tillwise.plans.intervals import overlap_join
from tillwise.plans.periods import WORD, active_months, first_month, merge_months, month_of, months_between, months_in

DAY0 = dt.date(1999, 12, 20)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def rough(spark):
    """Unknown customers and products, orders without lines, lines without orders, several orders and
    shipments of one day, shipments before the order, a gap of months, refunds below zero."""
    rng = random.Random(3)
    b = Builder()
    for c in range(1, 9):
        b.customer(c, nation=(c * 5) % 25)
    for p, kind in ((10, "STANDARD"), (11, "PROMO"), (12, "PROMO"), (13, "SMALL")):
        b.part(p, price=100.0, ptype=kind)
    starts = [0, 1, 1, 5, 30, 31, 89, 90, 91, 92, 180, 181, 270, 400, 401, 410, 500, 620, 710, 760, 800, 830]
    for i, n in enumerate(starts):
        b.order(i, [1, 1, 2, 3, 77, None, 4, 1][i % 8] if i < 16 else rng.randint(1, 8), str(day(n)))
        for k in range(i % 4):
            b.line(i, [10, 10, 11, 99, None, 13][(i + k) % 6], k + 1, [100.0, 0.0, -50.0, 12.3456, 1e7][(i * 3 + k) % 5],
                   discount=0.05 * (k % 3), flag="R" if k == 2 else "N", ship=str(day(n + [0, -3, 1, 7, 40, 130][(i + 2 * k) % 6])))
    b.line(3, 10, 2, 77.0, ship=str(day(9))).line(3, 10, 2, 88.0, ship=str(day(9)))
    b.line(999, 10, 5, 10.0, ship=str(day(3)))
    folder, tables = b.write(spark)
    return tables, duck_on(folder)


NEW = ["value_sketch_rollup", "sketch_accuracy", "line_value_percentiles", "rolling_region_sales", "last_shipment_price",
       "units_in_transit", "transit_peaks", "cohort_retention", "period_changes", "slow_movers_by_month",
       "unsold_products_by_month", "maintained_totals", "category_forecast"]


@pytest.mark.parametrize("name", NEW)
def test_rough_shop_matches_oracle(rough, name):
    tables, con = rough
    res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
    assert res.get("ok"), res
    assert res["spark_rows"] > 0


@pytest.mark.parametrize("name", NEW)
def test_empty_tables_give_empty_results(spark, rough, name):
    tables, _ = rough
    empty = tables.replace(**{n: getattr(tables, n).limit(0) for n in ("orders", "lineitem", "customer", "part")})
    assert QUERIES[name](empty).count() == 0


# Levels from events

def test_levels_equal_counting_each_day(spark):
    rng = random.Random(5)
    spans = [(rng.choice("ab"), day(a), day(a + rng.randint(1, 30)) if rng.random() < 0.9 else None, rng.randint(1, 9))
             for a in (rng.randint(-20, 60) for _ in range(200))]
    df = spark.createDataFrame(spans, "k string, s date, e date, n bigint")
    events = span_events(df, ["k"], "s", "e", ["n"])
    first, last = F.lit(day(0)), F.lit(day(70))
    levels = {(r.k, r.day): r.n for r in every_day(events, ["k"], ["n"], first, last).collect()}
    assert len(levels) == 2 * 71
    for (k, d), n in levels.items():
        assert n == sum(w for x, s, e, w in spans if x == k and s <= d and (e is None or d < e))
    assert running_levels(events, ["k"], ["n"]).count() == events.count()


@pytest.mark.parametrize("length", [1, 7, 90])
def test_presence_counts_each_key_once(spark, length):
    rng = random.Random(length)
    seen = sorted({(rng.choice("xyz"), rng.randint(0, 300)) for _ in range(120)})
    df = spark.createDataFrame([(k, day(n)) for k, n in seen], "k string, d date")
    moves = span_events(merged_presence(df, ["k"], "d", length).withColumn("n", F.lit(1)), ["k"], "start", "end", ["n"])
    events = moves.groupBy("day").agg(F.sum("n").alias("n"))
    levels = {r.day: r.n for r in every_day(events, [], ["n"], F.lit(day(0)), F.lit(day(400))).collect()}
    for n in range(0, 401, 3):
        if day(n) in levels:
            assert levels[day(n)] == len({k for k, m in seen if n - length < m <= n})


# As-of join

@pytest.mark.parametrize("slices", [1, 2, 7, 23])
@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_equals_looking_back(spark, slices, strict):
    rng = random.Random(slices)
    key = lambda: rng.choice(["hot", "hot", "hot", "b", "c", None])
    left = [(i, key(), day(rng.choice([None, *range(40)]))) for i in range(150)]
    right = [(key(), day(rng.choice([None, *range(0, 40, 3)])), rng.randint(0, 5)) for _ in range(60)]
    ldf = spark.createDataFrame(left, "i int, k string, at date").repartition(3)
    rdf = spark.createDataFrame(right, "k string, seen date, v int")
    found = {r.i: (r.seen, r.v) for r in asof_join(ldf, rdf, ["k"], "at", "seen", ["v"], strict, slices).collect()}
    assert len(found) == len(left)
    for i, k, at in left:
        fits = [(s, v) for x, s, v in right if x == k and s is not None and at is not None and (s < at or s == at and not strict)]
        assert found[i] == (max(fits) if fits else (None, None)), (i, k, at)


def test_asof_join_carries_over_slices_without_a_right_row(spark):
    left = spark.createDataFrame([(n, "a", day(100 + n)) for n in range(500)], "i int, k string, at date")
    right = spark.createDataFrame([("a", day(1), 7), ("b", day(2), 8)], "k string, seen date, v int")
    found = asof_join(left, right, ["k"], "at", "seen", ["v"], slices=16)
    assert found.where("v = 7").count() == 500


# Interval join

@pytest.mark.parametrize("width", [1, 8, 32, 1000])
def test_interval_join_equals_all_pairs_that_overlap(spark, width):
    rng = random.Random(width)
    def spans(n, tag):
        out = []
        for i in range(n):
            a = rng.choice([None, *range(-10_990, -10_900), *range(0, 90)])
            out.append((tag + i, rng.choice(["hot", "hot", "b", None]), day(a),
                        None if a is None else day(a + rng.choice([-2, 0, 1, 3, 40, 150]))))
        return out
    left, right = spans(80, 0), spans(60, 1000)
    ldf = spark.createDataFrame(left, "i int, k string, a date, b date")
    rdf = spark.createDataFrame(right, "j int, k string, c date, d date")
    found = sorted((r.i, r.j) for r in overlap_join(ldf, rdf, ["k"], ("a", "b"), ("c", "d"), width).collect())
    want = sorted((i, j) for i, k, a, b in left for j, x, c, d in right
                  if k is not None and k == x and None not in (a, b, c, d) and a < b and c < d and a < d and c < b)
    assert found == want and found


def test_interval_join_without_buckets_equals_one_with_them(spark):
    rng = random.Random(11)
    spans = lambda n: [(i, rng.choice(["hot", "hot", "b", None]), day(a), day(a + rng.choice([-2, 0, 1, 40, 1500])))
                       for i, a in enumerate(rng.choice([-9000, 0, 30, 700]) + rng.randint(0, 60) for _ in range(n))]
    ldf = spark.createDataFrame([*spans(90), (90, "b", None, day(5)), (91, "b", day(5), None)], "i int, k string, a date, b date")
    rdf = spark.createDataFrame([*spans(20), (20, "b", day(1), None)], "j int, k string, c date, d date")
    pairs = lambda width: sorted((r.i, r.j) for r in overlap_join(ldf, rdf, ["k"], ("a", "b"), ("c", "d"), width).collect())
    assert pairs(None) == pairs(16) and pairs(None)


def test_transit_lines_are_not_multiplied_by_the_length_of_their_spans(rough):
    tables, _ = rough
    plan = QUERIES["transit_peaks"](tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


# Month bitmaps

def test_bitmaps_hold_the_months_and_merge(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 5), dt.date(rng.randint(1960, 2040), rng.randint(1, 12), rng.randint(1, 28))) for _ in range(300)]
    df = spark.createDataFrame([*rows, (1, None)], "k int, d date")
    whole = active_months(df, "k", "d")
    halves = merge_months(active_months(df.where("k % 2 = 0 or month(d) < 7"), "k", "d"),
                          active_months(df.where("month(d) >= 5"), "k", "d"), key="k")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, halves.collect()))
    months = whole.select("k", F.explode(months_in(F.col("word"), F.col("bits"))).alias("m"))
    found = {(r.k, r.d) for r in months.select("k", month_of(F.col("m")).alias("d")).collect()}
    assert found == {(k, d.replace(day=1)) for k, d in rows}
    first = whole.groupBy("k").agg(F.min(first_month(F.col("word"), F.col("bits"))).alias("m")).select("k", month_of(F.col("m")).alias("d"))
    assert {(r.k, r.d) for r in first.collect()} == {(k, min(d for x, d in rows if x == k).replace(day=1)) for k, _ in rows}


def test_masks_of_periods(spark):
    cases = [(w, a, b) for w in (0, 3) for a in (0, 100, 179, 180, 185, 239, 240, 500) for b in (0, 101, 180, 200, 240, 600)]
    df = spark.createDataFrame(cases, "w bigint, a bigint, b bigint")
    for r in df.select("*", months_between(F.col("w"), F.col("a"), F.col("b")).alias("m")).collect():
        assert r.m == sum(1 << (n - r.w * WORD) for n in range(max(r.a, r.w * WORD), min(r.b, (r.w + 1) * WORD)))


def test_changes_between_any_two_periods(spark, rough):
    tables, _ = rough
    number = lambda y, m: F.lit(y * 12 + m - 1).cast("bigint")
    got = retention.period_changes(tables, (number(2000, 1), number(2000, 7)), (number(2001, 1), number(2001, 7))).collect()
    seen = {}
    for r in tables.orders.where("o_custkey is not null").collect():
        seen.setdefault(r.o_custkey, []).append(r.o_orderdate.date())
    inside = lambda c, y: any(d.year == y and d.month < 7 for d in seen[c])
    assert sum(r.kept for r in got) == sum(inside(c, 2000) and inside(c, 2001) for c in seen)
    assert sum(r.lost for r in got) == sum(inside(c, 2000) and not inside(c, 2001) for c in seen)
    assert sum(r.new + r.returned for r in got) == sum(inside(c, 2001) and not inside(c, 2000) for c in seen)


# Forecast

def test_a_line_with_seasons_is_recovered(spark):
    b = Builder().customer(1).part(1, ptype="A").part(2, ptype="B")
    for n in range(36):
        month = dt.date(2000 + n // 12, n % 12 + 1, 28 if n < 35 else 31)
        b.order(n, 1, str(month)).line(n, 1, 1, 1000.0 + 10 * n + 100 * (n % 12))
        if n < 20:
            b.line(n, 2, 1, 50.0)
    _, tables = b.write(spark)
    rows = {(r.category, r.month): r for r in forecast.category_forecast(tables).collect()}
    assert len(rows) == 6
    for n in (36, 37, 38):
        r = rows["A", dt.date(2003, n - 35, 1)]
        assert (r.forecast, r.monthly_slope, r.rmse, r.n_months) == (1000.0 + 10 * n + 100 * (n % 12), 10.0, 0.0, 36)
    assert rows["B", dt.date(2003, 1, 1)].monthly_slope < 0


def test_one_year_has_levels_and_no_slope(spark):
    b = Builder().customer(1).part(1, ptype="A")
    for n in range(4):
        b.order(n, 1, f"2000-{n + 1:02d}-28").line(n, 1, 1, 100.0 * (n + 1))
    b.order(9, 1, "2000-05-02").line(9, 1, 1, 1.0)   # May is not over
    _, tables = b.write(spark)
    rows = sorted(forecast.category_forecast(tables).collect(), key=lambda r: r.month)
    assert [(r.month, r.forecast, r.monthly_slope, r.n_months) for r in rows] == [
        (dt.date(2000, m, 1), 250.0, 0.0, 4) for m in (5, 6, 7)]


def test_moments_of_parts_add_up(spark, sf001_tables):
    series = forecast.category_months(sf001_tables).cache()
    parts = [forecast.season_moments(series.where(c)) for c in ("at < 30", "at >= 30")]
    merged = parts[0].unionByName(parts[1]).groupBy("category", "season").agg(*[F.sum(c).alias(c) for c in ("n", "t", "y", "tt", "ty")])
    key = lambda rows: sorted(str([r[c] for c in ("category", "season", "n", "t", "y", "tt", "ty")]) for r in rows)
    assert key(merged.collect()) == key(forecast.season_moments(series).collect())
