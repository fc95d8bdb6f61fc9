"""The operators' queries against their DuckDB SQL on the smallest tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.differential import compare, duck_connection
from viewstar.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck_connection(SF_SMALL))
    assert r["ok"], r
