from __future__ import annotations

import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "count_nearby_cultural" in df.columns


@pytest.mark.parametrize("name", ["dense_key", "stream_consume", "fact_build", "describe_numeric"])
def test_queries_run(spark, name):
    assert E.queries()[name](spark, SMALL).count() > 0


@pytest.mark.parametrize(
    "name",
    ["histogram", "kde_curve", "category_encode", "work_list_cross", "fuzzy_standardize", "left_join_fill", "enrich_details"],
)
def test_plans_have_no_all_pairs_join(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns_and_push_filters(spark):
    plan = E.queries()["haversine_distance"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    plan = E.queries()["check_foreign_key"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,0.0)" in plan
