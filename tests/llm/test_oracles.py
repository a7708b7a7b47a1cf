"""Registered corpus queries against their SQL."""

import pytest

from tests.oracle_compare import compare, duck
from tillwise.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    res = compare(QUERIES[name](spark, folder), duck(folder), SQL[name])
    assert res.get("ok"), res


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
