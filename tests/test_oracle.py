"""Every registered question equals its independent DuckDB SQL at sf0.01."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare
from tillwise.catalog import QUERIES

NAMES = sorted(QUERIES)


def test_every_question_has_an_oracle():
    """Of this library's own questions; corpus operators are registered beside them."""
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf001_tables, duck001, name):
    res = compare(QUERIES[name](sf001_tables), duck001, entry.oracle_sql()[name])
    assert res.get("ok"), res


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("name", NAMES)
def test_sort_merge_plans_match_oracle(spark, sf0001, name, adaptive):
    """With Spark's broadcast thresholds off and AQE on and off, every join between tables is a
    sort-merge join, as when no table is small; results must not change."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive,
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tables, con = sf0001
        df = QUERIES[name](tables)
        with contextlib.redirect_stdout(buf := io.StringIO()):
            df.explain()
        # Hinted sides are bounded by their query: slice offsets, the values of a top k.
        hinted = {"pareto_products", "pareto_customers", "slow_movers", "slow_movers_by_month", "customer_rank_family",
                  "top_products", "top_customers_by_orders", "last_shipment_price"}
        if name not in hinted:
            assert "BroadcastHashJoin" not in buf.getvalue()
        res = compare(df, con, entry.oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert res.get("ok"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["grain", "year", "quarter", "month", "revenue", "n_lines"]


OTHER_SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200",
                  "spark.sql.ansi.enabled": "false",
                  "spark.sql.session.timeZone": "America/Los_Angeles"}


@pytest.mark.parametrize("name", ["revenue_growth", "purchase_gaps", "customer_rank_family",
                                  "slow_movers", "category_region_growth", "customer_ltv",
                                  "moving_avg_day", "revenue_by_period"])
def test_matches_oracle_under_other_session_settings(spark, sf001_tables, duck001, name):
    """Results do not depend on AQE, partition count, ANSI mode or the session time zone."""
    before = {k: spark.conf.get(k) for k in OTHER_SETTINGS}
    for k, v in OTHER_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        res = compare(QUERIES[name](sf001_tables), duck001, entry.oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert res.get("ok"), res


@pytest.fixture(scope="module")
def sf0001(spark):
    from tests.oracle_compare import duck
    from tillwise.sources.tables import load_tables
    return load_tables(spark, "/root/testdata/sf0.001"), duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle_at_sf0001(sf0001, name):
    tables, con = sf0001
    res = compare(QUERIES[name](tables), con, entry.oracle_sql()[name])
    assert res.get("ok"), res
