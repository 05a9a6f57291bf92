"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    ok, detail, _ = compare(spark, duck(SF), name, SF)
    assert ok, detail


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
