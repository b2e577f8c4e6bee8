from __future__ import annotations

import pytest
from conftest import rows

from geomart.operators import quality as Q

SUITE = Q.Suite(
    "s",
    (
        Q.Expectation(Q.BETWEEN, "v", 0, 10),
        Q.Expectation(Q.NOT_NULL, "v"),
        Q.Expectation(Q.IN_SET, "g", value_set=("a", "b")),
        Q.Expectation(Q.EXISTS, "missing"),
        Q.Expectation(Q.NOT_NULL, "missing"),
    ),
)


def data(spark):
    return spark.createDataFrame([(0, "a"), (10, None), (11, "c"), (None, "b")], "v int, g string")


def test_validate_counts(spark):
    got = {(r.expectation, r.column_name): (r.element_count, r.null_count, r.unexpected_count, r.success) for r in Q.validate(data(spark), SUITE).collect()}
    assert got[Q.BETWEEN, "v"] == (4, 1, 1, False)
    assert got[Q.NOT_NULL, "v"] == (4, 1, 1, False)
    assert got[Q.IN_SET, "g"] == (4, 1, 1, False)
    assert got[Q.EXISTS, "missing"] == (None, None, None, False)
    assert got[Q.NOT_NULL, "missing"][3] is False


def test_one_scan_per_suite(spark, tmp_path):
    path = str(tmp_path / "t")
    data(spark).write.parquet(path)
    plan = Q.validate(spark.read.parquet(path), SUITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_split_and_gate(spark):
    with pytest.raises(Q.QualityError, match="missing"):
        Q.split(data(spark), SUITE)  # no row could be told to pass
    good, bad = Q.split(data(spark), Q.Suite("present", SUITE.expectations[:3]))
    assert rows(good) == [(0, "a"), (10, None)]
    assert {(r.v, tuple(r.failed_checks)) for r in bad.collect()} == {
        (11, (f"{Q.BETWEEN}:v", f"{Q.IN_SET}:g")),
        (None, (f"{Q.NOT_NULL}:v",)),
    }
    with pytest.raises(Q.QualityError, match="between"):
        Q.gate(data(spark), SUITE)
    ok = Q.Suite("ok", (Q.Expectation(Q.IN_SET, "g", value_set=("a", "b", "c")),))
    assert Q.gate(data(spark), ok).count() == 4


def test_suite_json_round_trip(tmp_path):
    path = str(tmp_path / "suite.json")
    for suite in (Q.LISTINGS_SUITE, Q.PLACES_SUITE, SUITE):
        suite.save(path)
        assert Q.Suite.load(path) == suite


def test_constraints(spark):
    df = data(spark)
    assert rows(Q.check_unique(df.union(df.where("v = 0")), ["v"])) == [(0, 2)]
    parent = spark.createDataFrame([(0,), (10,)], "k int")
    assert rows(Q.check_foreign_key(df, "v", parent, "k")) == [(11, 1)]
