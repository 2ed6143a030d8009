"""Every query with an SQL twin gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as contract
from tools.compare import compare, duck


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_same_rows(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir).startswith("ok")


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1094
