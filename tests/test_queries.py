"""Queries against their SQL twin; ``compare.py`` does the same for all of them at any scale."""

import pytest

from compare import compare, connect
from waybill.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    rows, problem = compare(spark, duck, SF, name)
    assert problem is None and rows > 0


def test_every_query_has_its_sql():
    from waybill.plans.oracle import ORACLE
    assert set(QUERIES) == set(ORACLE)
