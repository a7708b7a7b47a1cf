"""Physical plan checks: pushdown, pruning, no nested-loop or cartesian joins, no
one-partition window over entity-sized data, and the pre-aggregation path for large
dimensions."""

import contextlib
import io

import pytest

from tillwise.catalog import QUERIES
from tillwise.operators import descriptive, diagnostic, strategic


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_the_scan(sf001_tables):
    text = plan(descriptive.filtered_orders(sf001_tables))
    assert "GreaterThan(o_totalprice,400000.0)" in text
    assert "EqualTo(o_orderstatus,F)" in text


def test_columns_pruned_at_scan(sf001_tables):
    text = plan(descriptive.revenue_by_period(sf001_tables))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(sf001_tables, name):
    text = plan(QUERIES[name](sf001_tables))
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text


@pytest.fixture
def sort_merge(spark):
    """Spark's broadcast thresholds off: every join of tables is a sort-merge join."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("fn", [strategic.pareto_products, strategic.pareto_customers,
                                diagnostic.slow_movers, descriptive.customer_rank_family])
def test_entity_windows_are_sliced(sf001_tables, fn):
    """Windows over one row per product or customer partition by slice, never by nothing."""
    text = plan(fn(sf001_tables))
    assert "Window" in text and "_slice" in text
    for line in text.splitlines():
        if line.strip().startswith("Arguments:") and "windowspecdefinition(" in line:
            if "_slice" not in line:
                # the only unpartitioned windows allowed run over the per-slice offsets table
                assert "_cnt" in line or "_tot_" in line, line


@pytest.mark.parametrize("fn", [descriptive.top_products, descriptive.top_customers_by_orders])
def test_top_k_windows_run_over_distinct_values(sf001_tables, fn):
    """No window over entities: the only one numbers the at most k distinct values at the top, and
    the k-th value comes from a limited sort."""
    text = plan(fn(sf001_tables))
    assert "TakeOrderedAndProject" in text
    windows = [line for line in text.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("_rows" in line for line in windows)


def test_lines_are_summed_per_order_before_the_join(sf001_tables, sort_merge):
    text = plan(descriptive.revenue_by_period(sf001_tables))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "partial_sum" in text and "Keys [1]: [l_orderkey" in text


@pytest.mark.parametrize("name", ["margin_trend", "margin_volume_corr", "category_growth",
                                  "category_region_growth", "revenue_cube", "customer_ltv", "category_forecast"])
def test_products_meet_reduced_lines(sf001_tables, sort_merge, name):
    """The product table is never joined to raw lines: the join's other side is an aggregate per
    product."""
    import re
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](sf001_tables).explain()
    lines = buf.getvalue().splitlines()
    joins = [i for i, x in enumerate(lines) if re.search(r"SortMergeJoin \[l_partkey", x)]
    assert joins
    for i in joins:
        below = [x for x in lines[i + 1:] if not re.search(r"Sort |Project|Exchange|InputAdapter|WholeStage", x)]
        assert "HashAggregate(keys=[l_partkey" in below[0], below[0]


@pytest.mark.parametrize("fn, keys", [
    (diagnostic.purchase_gaps, ("o_custkey", "order_date")),
    (descriptive.stock_movement_monthly, ("p_partkey", "month")),
])
def test_per_entity_windows_run_over_reduced_rows(sf001_tables, fn, keys):
    """The window partitioned by customer or product reads an aggregate keyed by entity and
    calendar period, so a hot entity holds at most one row per day or month."""
    text = plan(fn(sf001_tables))
    window_at = text.index("Window")
    agg_keys = [line for line in text.splitlines() if line.startswith("Keys [2]:")]
    assert any(all(k in line for k in keys) for line in agg_keys), agg_keys
    assert window_at >= 0


def test_a_days_window_is_an_event_sweep(sf001_tables):
    """Rolling sales look back by entries and exits: every window runs over sums per region and day, or
    over a customer's distinct days; none has a frame of days."""
    text = plan(QUERIES["rolling_region_sales"](sf001_tables))
    assert "rangeframe" not in text.lower()
    for line in text.splitlines():
        if "windowspecdefinition(" in line:
            assert "region" in line or "o_custkey" in line, line


@pytest.mark.parametrize("name", ["units_in_transit", "transit_peaks"])
def test_lines_are_never_spread_over_their_days(sf001_tables, name):
    text = plan(QUERIES[name](sf001_tables))
    assert "interval 1 day" not in text.lower() and "explode(sequence(order_date" not in text


def test_asof_join_windows_are_sliced(sf001_tables):
    text = plan(QUERIES["last_shipment_price"](sf001_tables))
    for line in text.splitlines():
        if "windowspecdefinition(" in line:
            assert "_slice" in line, line
