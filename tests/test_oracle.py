"""Every registered query against its DuckDB oracle on the sf0.01 fixture."""

import pytest
from helpers import SF01

import __spark_entry__ as entry
from shoplens.plans.compare import compare, duckdb_connection
from shoplens.plans.queries import registry

NAMES = list(registry())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    rep = compare(entry.queries()[name](spark, SF01), con, entry.oracle_sql()[name])
    assert rep["values_match"] and rep["types_match"], rep


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "product_name", "cnt", "rk", "remark"]
    assert df.count() > 0
