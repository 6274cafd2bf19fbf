"""The queries that have SQL against DuckDB, as the correctness gate runs them."""

import pytest

from bandwise.llm import queries
from tests.conftest import SMALL
from tests.harness import compare, duck


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(queries.queries()[name](spark, SMALL), duck(SMALL), queries.oracle_sql()[name])
    assert res["columns_ok"] and res["types_ok"] and res["rows"][0] == res["rows"][1] and res["values_ok"], res
