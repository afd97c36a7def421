"""Every catalog query beside its SQL statement on the smallest test tables."""

import pytest
from oracle_check import compare, duck

import __spark_entry__
from saleslayers.catalog.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name]) == []


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    df = __spark_entry__.entry(spark)
    assert df.columns[:3] == ["sales_month", "supplier_id", "supplier_name"]
    assert df.count() > 0
