"""Deployment check: with lineitem and orders bucketed by order key (catalog tables), the
large-data plan joins lines to orders without exchanging either side."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF001
from tillwise.catalog import QUERIES
from tillwise.sources.tables import SCHEMAS, Tables
from tests.oracle_compare import compare
import __spark_entry__ as entry

BUCKETS = 8


@pytest.fixture(scope="module")
def bucketed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_bucketed")
    for name in SCHEMAS:
        df = spark.read.parquet(f"{SF001}/{name}.parquet")
        writer = df.write.mode("overwrite").format("parquet")
        key = {"lineitem": "l_orderkey", "orders": "o_orderkey"}.get(name)
        if key:
            writer = writer.bucketBy(BUCKETS, key).sortBy(key)
        writer.saveAsTable(f"tw_bucketed.{name}")
    return Tables.from_catalog(spark, "tw_bucketed")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def sort_merge(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": str(BUCKETS)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def line_join(text: str) -> str:
    """The plan below the join of lines to orders."""
    start = re.search(r"SortMergeJoin \[(l_orderkey|o_orderkey)", text)
    return text[start.start():].split("\n", 1)[1]


def test_line_order_join_needs_no_exchange(bucketed, duck001, sort_merge):
    df = QUERIES["revenue_by_period"](bucketed)
    text = plan(df)
    # the join's inputs reach their bucketed scans without an exchange; the only exchanges
    # left are the monthly aggregate's, above the join
    assert "Exchange" not in line_join(text), text
    assert "Bucketed: true" in text or "SelectedBucketsCount" in text, text
    res = compare(df, duck001, entry.oracle_sql()["revenue_by_period"])
    assert res.get("ok"), res


@pytest.mark.parametrize("name", ["margin_trend", "category_growth", "customer_ltv", "unsold_products"])
def test_lines_meet_orders_without_an_exchange(bucketed, duck001, sort_merge, name):
    """No exchange of raw lines by order key: whatever is exchanged below the join is no line scan."""
    df = QUERIES[name](bucketed)
    text = plan(df)
    below = line_join(text)
    for part in re.split(r"\n(?=.*Exchange hashpartitioning\([lo]_orderkey)", below)[1:]:
        assert "tw_bucketed.lineitem" not in part.split("SortMergeJoin")[0], text
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey", below), text
    res = compare(df, duck001, entry.oracle_sql()[name])
    assert res.get("ok"), res


def test_recent_window_reads_lines_in_place(bucketed, sort_merge):
    """Units of the last 90 days: the semi-join that finds the lines of recent orders exchanges
    neither bucketed table."""
    from tillwise.operators.diagnostic import recent_orders
    from tillwise.plans.facts import product_totals
    text = plan(product_totals(bucketed, recent_orders(bucketed, 90)))
    assert "LeftSemi" in text
    assert not re.search(r"Exchange hashpartitioning\([lo]_orderkey", text), text
