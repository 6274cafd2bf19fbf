"""Every registered query against its DuckDB oracle (sf0.001), as the correctness gate runs it."""

import pytest

from bandwise.plans import registry
from tests.conftest import SMALL
from tests.harness import compare, duck

SQL_QUERIES = [k for k, q in registry.REGISTRY.items() if q.sql is not None]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, con, name):
    q = registry.REGISTRY[name]
    df = q.run(spark, SMALL)
    res = compare(df, con, q.sql)
    assert res["columns_ok"] and res["types_ok"] and res["rows"][0] == res["rows"][1] and res["values_ok"], res
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan], plan


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 17
    assert set(e.oracle_sql()) <= set(e.queries())


def test_registered_plans_have_no_python_udf_or_cartesian(spark):
    for name in ("clean_full", "range_report", "over_under_two_stage", "dow_sales_profile", "encode_calendar"):
        plan = registry.REGISTRY[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
