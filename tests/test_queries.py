"""Every registered query against its SQL, and what its plan must not contain."""

import check
import pytest

import __spark_entry__ as entry
from basketloom.catalog import load

QUERIES, CHECKS = load()
PYTHON = {"udf_scalar", "udf_row", "udf_vectorized", "haversine_variants"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "EvalPython" not in plan and "MapInPandas" not in plan
    bad, _ = check.compare(df, con, CHECKS[name])
    assert bad is None, bad


def test_all_queries_have_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "customer_id"
