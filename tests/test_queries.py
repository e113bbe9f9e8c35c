"""Every query of the catalogue against its SQL counterpart; the subpackage llm has tests of its own."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from tidecall.plans.catalogue import ORACLES, QUERIES



@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, small, name):
    df = QUERIES[name](spark, small)
    check_plan(df)
    assert compare(df, con, ORACLES[name]) is None


def check_plan(df):
    """No cross join, no nested loop and no Python in any physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert bad not in plan


def test_scans_read_only_the_columns_they_need(spark, small):
    plan = QUERIES["job_category"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_filters_reach_the_scan(spark, small):
    plan = QUERIES["snapshot_diff"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), Not(EqualTo(o_orderpriority,1-URGENT))]" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["job_category", "target_rate", "n"]
    assert df.count() > 0
