"""Every registered query against DuckDB on the small tables, plus plan checks."""

import pytest

from riskframe.catalog import QUERIES, Tables
from tests.oracle import compare, connect


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    q = QUERIES[name]
    ok, message, _ = compare(spark, con, lambda s, d: q.run(Tables(s, d)), q.sql, sf_dir)
    assert ok, message


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


UDF_KEYS = {"udf_scalar", "udf_row_array", "udf_group", "udtf_parse"}
EAGER = ("scan_", "sink_", "stream_")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in UDF_KEYS and not n.startswith(EAGER)])
def test_plan_stays_on_the_jvm(spark, sf_dir, name):
    plan = plan_of(QUERIES[name].run(Tables(spark, sf_dir)))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan
    # the only nested-loop join allowed is none at all: every join has an equality
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned_and_filter_pushed(spark, sf_dir):
    plan = plan_of(QUERIES["filt_threshold"].run(Tables(spark, sf_dir)))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,300000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


@pytest.mark.parametrize("name", ["topk_largest", "topk_smallest", "topk_abs", "prof_head", "prof_sample_n", "limit_first_n"])
def test_top_n_needs_no_full_sort(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name].run(Tables(spark, sf_dir)))
