"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.differential import compare, duck_connection
from tests.conftest import SF_SMALL
from viewstar.catalog import QUERIES as CATALOG

ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in CATALOG}
QUERIES = CATALOG


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_id", "views"]
    assert 0 < df.count() <= 10
