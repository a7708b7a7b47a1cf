"""Sketches and exact percentiles against brute force; stored layouts and maintained sums."""

import contextlib
import datetime as dt
import glob
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import Builder
from tillwise.operators import descriptive, diagnostic, maintained
from tillwise.plans import sketches
from tillwise.plans.selection import exact_percentiles
from tillwise.session import ensure_checkpoint_dir
from tillwise.sources.partitioned import read_by_month, write_by_month


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def fresh(spark, name):
    import uuid
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}".replace("file:", "")


# Sketches

def test_buckets_keep_order_and_their_error(spark):
    rng = random.Random(1)
    values = sorted({0, 1, -1, 127, 128, 255, 256, 257, 511, 512, 2 ** 40, 2 ** 40 - 1, 10 ** 18, -10 ** 18,
                     *[rng.randint(-10 ** 12, 10 ** 12) for _ in range(500)], *range(-300, 300)})
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", sketches.value_bucket(F.col("v")).alias("b"))
    rows = df.select("v", "b", sketches.bucket_middle(F.col("b")).alias("m")).orderBy("v").collect()
    assert all(a.b <= c.b for a, c in zip(rows, rows[1:]))
    for r in rows:
        assert abs(r.m - r.v) <= abs(r.v) * sketches.VALUE_ERROR and (r.m == r.v or abs(r.v) >= 256)


def test_sketches_of_months_merge_to_the_sketch_of_all(spark, sf001_tables):
    t = sf001_tables
    early, late = F.col("o_orderdate") < F.lit("1998-03-10").cast("timestamp_ntz"), F.col("o_orderdate") >= F.lit("1998-03-10").cast("timestamp_ntz")
    whole = sketches.rollup(sketches.sales_sketches(t))
    parts = [sketches.sales_sketches(t.replace(orders=t.orders.where(c))) for c in (early, late)]   # one month is in both
    merged = sketches.rollup(sketches.merge_states(*parts))
    key = lambda df: sorted(str(tuple(r)) for r in df.drop("buyers_estimate").collect())
    assert key(whole) == key(merged)
    total = {r.grain: r.buyers_estimate for r in merged.where("grain = 'all'").collect()}["all"]
    exact = t.orders.select("o_custkey").distinct().count()
    assert abs(total - exact) <= sketches.BUYER_ERROR * exact


def test_the_rollup_reads_only_the_state(spark, sf001_tables):
    from tillwise.operators.distribution import sketch_state
    text = plan(sketches.rollup(sketch_state(sf001_tables)))
    assert "sales-sketches" in text and "lineitem" not in text and "orders" not in text


# Selection

def place(values, p):
    return sorted(values)[max(1, (len(values) * p + 99) // 100) - 1]


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_percentiles_equal_sorting(spark, bits):
    rng = random.Random(bits)
    spread = 200 if bits == 1 else 10 ** 9
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.randint(-spread, spread)) for _ in range(400)]
    rows += [("hot", None, rng.choice([5, 7, rng.randint(0, 10 ** 6)]) if bits > 1 else rng.choice([5, 7, 150])) for _ in range(300)]
    rows += [("a", 1, None), ("lone", 1, 42), ("void", 1, None)]
    df = spark.createDataFrame(rows, "k string, g int, v bigint")
    found = {(r.k, r.g): r for r in exact_percentiles(df, ["k", "g"], "v", [1, 50, 95, 100], digit_bits=bits).collect()}
    groups = {}
    for k, g, v in rows:
        if v is not None:
            groups.setdefault((k, g), []).append(v)
    assert set(found) == set(groups)
    for key, values in groups.items():
        r = found[key]
        assert (r.n, r.p1, r.p50, r.p95, r.p100) == (len(values), *[place(values, p) for p in (1, 50, 95, 100)])


def test_weighted_percentiles_count_rows_of_a_value_together(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randint(0, 10 ** 7), rng.randint(0, 9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v bigint, w int")
    for r in exact_percentiles(df, ["k"], "v", [50], weight="w").collect():
        values = [v for k, v, w in rows if k == r.k for _ in range(w)]
        assert (r.n, r.p50) == (len(values), place(values, 50))


def test_a_value_that_counts_in_several_groups_is_held_once_and_stays_in_place(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, rng.randint(-10 ** 9, 10 ** 9)]), rng.randint(0, 3))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, g int, v bigint, w int")
    none = F.lit(None).cast("string")
    groups = F.array(*[F.struct(F.lit(name).alias("grain"), k.alias("k")) for name, k in (("k", F.col("k")), ("all", none))])
    out = exact_percentiles(df, ["grain", "k"], "v", [50, 95], weight="w", base=["k"], groups=groups)
    want = {}
    for k, _, v, w in rows:
        for key in (("k", k), ("all", None)):
            want.setdefault(key, []).extend([v] * w if v is not None else [])
    got = {(r.grain, r.k): (r.n, r.p50, r.p95) for r in out.collect()}
    assert got == {key: (len(vs), place(vs, 50), place(vs, 95)) for key, vs in want.items() if vs}
    text = plan(out)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text   # the values meet few slices where they are


def test_percentiles_of_nothing_and_of_too_wide_a_range(spark):
    df = spark.createDataFrame([("a", -(2 ** 62)), ("a", 2 ** 62)], "k string, v bigint")
    assert exact_percentiles(df.limit(0), ["k"], "v", [50]).count() == 0
    with pytest.raises(ValueError):
        exact_percentiles(df, ["k"], "v", [50])


def test_a_hot_group_is_counted_and_never_gathered(spark):
    """Whatever a group holds, what is shuffled for it is one row per task and slice of its range."""
    df = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 1_000_003).alias("v")).repartition(8)
    out = exact_percentiles(df, ["k"], "v", [50])
    row = out.first()
    values = sorted(i * 7919 % 1_000_003 for i in range(200_000))
    assert row.p50 == values[99_999]
    text = plan(out)
    for line in text.splitlines():
        if "windowspecdefinition(" in line:
            assert "_c" in line, line                     # windows run over counts
    assert "partial_sum(_w" in text and "collect_list" not in text


# Layout by month

def test_recent_windows_read_recent_months_only(spark, sf001_tables):
    """Files of earlier months are overwritten with rubbish: the answers stay, as nobody opens them."""
    folder = fresh(spark, "pruned")
    write_by_month(sf001_tables, folder)
    t = read_by_month(spark, folder, sf001_tables)
    assert t.lineitem.count() == sf001_tables.lineitem.count() and t.orders.count() == sf001_tables.orders.count()
    want = sorted(map(tuple, diagnostic.slow_movers(sf001_tables).collect()))
    unsold = sorted(map(tuple, diagnostic.unsold_products(sf001_tables).collect()))
    last = max(os.path.basename(p) for p in glob.glob(f"{folder}/lineitem.parquet/l_order_month=*"))
    floor = (dt.date.fromisoformat(last[-10:]) - dt.timedelta(days=92)).replace(day=1)
    spoiled = 0
    for path in glob.glob(f"{folder}/lineitem.parquet/*/*.parquet"):
        if dt.date.fromisoformat(path.split("=")[1][:10]) < floor:
            with open(path, "wb") as f:
                f.write(b"rubbish")
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
            spoiled += 1
    assert spoiled > 50
    t = read_by_month(spark, folder, sf001_tables)
    assert sorted(map(tuple, diagnostic.slow_movers(t).collect())) == want
    assert sorted(map(tuple, diagnostic.unsold_products(t).collect())) == unsold
    with pytest.raises(Exception):
        t.lineitem.select(F.sum("l_quantity")).collect()
    lines = [x for x in plan(diagnostic.unsold_products(t)).splitlines() if "PartitionFilters" in x and "l_order_month" in x]
    assert lines and all("Subquery" in x for x in lines)


# Maintained sums

def shop(extra=()):
    b = Builder().customer(1, nation=0).customer(2, nation=7).part(1, ptype="A").part(2, ptype="B")
    for i, (day, part, price) in enumerate([("2000-01-05", 1, 10.0), ("2000-01-31", 2, 20.0), ("2000-03-02", 1, 30.0), *extra]):
        b.order(i, 1 + i % 2, day).line(i, part, 1, price)
    return b


def totals(spark, folder):
    return sorted(map(str, maintained.period_totals(maintained.kept_sums(spark, folder)).collect()))


def files(folder):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{folder}/month=*/*.parquet")}


def test_a_new_month_is_merged_and_a_rerun_changes_nothing(spark):
    folder, march, april = fresh(spark, "kept"), dt.date(2000, 3, 1), dt.date(2000, 4, 1)
    _, old = shop().write(spark)
    maintained.refresh(old, folder)
    before = files(folder)
    _, new = shop([("2000-04-09", 2, 40.0), ("2000-03-09", 9, 5.0)]).write(spark)
    maintained.refresh(new, folder, march, april)
    after = files(folder)
    assert {p: at for p, at in after.items() if "2000-01" in p} == {p: at for p, at in before.items() if "2000-01" in p}
    whole = fresh(spark, "whole")
    maintained.refresh(new, whole)
    assert totals(spark, folder) == totals(spark, whole)
    maintained.refresh(new, folder, march, april)
    maintained.refresh(new, folder, april, april)
    assert totals(spark, folder) == totals(spark, whole)


def test_a_month_that_lost_its_lines_is_emptied(spark):
    folder = fresh(spark, "kept")
    _, t = shop().write(spark)
    maintained.refresh(t, folder)
    gone = t.replace(orders=t.orders.where(F.col("o_orderdate") < F.lit("2000-02-01").cast("timestamp_ntz")))
    maintained.refresh(gone, folder, dt.date(2000, 2, 1), dt.date(2000, 3, 1))
    whole = fresh(spark, "whole")
    maintained.refresh(gone, whole)
    assert totals(spark, folder) == totals(spark, whole)


def test_stored_sums_equal_the_revenue_question(spark, sf001_tables):
    folder = fresh(spark, "kept")
    maintained.refresh(sf001_tables, folder)
    got = {(r.year, r.month): (r.revenue, r.n_lines) for r in maintained.period_totals(maintained.kept_sums(spark, folder))
           .where("grain = 'month'").collect()}
    want = {(r.year, dt.date(r.year, r.month, 1)): (r.revenue, r.n_lines)
            for r in descriptive.revenue_by_period(sf001_tables).where("grain = 'month'").collect()}
    assert got == want
