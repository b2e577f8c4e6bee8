from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from geomart.operators import increments as I

EXACT = ["column_name", "rows", "null_count", "mean", "std", "least", "most"]


def data(spark, lo=0, hi=20_000):
    k = F.col("id")
    return spark.range(lo, hi).select(
        F.when(k % 7 != 0, (k * 37 % 5000) / 3).alias("x"),
        F.when(k % 11 == 0, F.lit(float("nan"))).otherwise(k * 1.0 + 1e9).alias("far"),
        (k % 12).cast("int").alias("few"),
        F.concat(F.lit("n"), k % 3000).alias("name"),
    )


def by_column(df):
    return {r.column_name: r for r in df.collect()}


def test_merged_batches_equal_the_whole(spark, tmp_path):
    store = I.ProfileStore(spark, str(tmp_path / "p"))
    assert not store.exists()
    cuts = [0, 3, 9000, 9000, 20_000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        store.add(f"b{i}", data(spark, a, b))
    got, df = by_column(store.profile()), data(spark).withColumn("far", F.nanvl("far", F.lit(None)))
    for c in ("x", "far", "few"):
        want = df.agg(F.count("*"), F.count_if(F.col(c).isNull()), F.avg(c), F.stddev(c), F.min(c), F.max(c), F.count_distinct(c)).first()
        own = got[c]
        assert (own.rows, own.null_count, own.least, own.most) == (want[0], want[1], want[4], want[5])
        assert own.mean == pytest.approx(want[2], rel=1e-12) and own.std == pytest.approx(want[3], rel=1e-9)
        assert own.approx_distinct == pytest.approx(want[6], rel=0.05)
        n = df.where(F.col(c).isNotNull()).count()
        for q in I.QUANTILES:  # the rank of the value given is near the one asked for
            value = own[f"approx_q{round(q * 100)}"]
            below, upto = df.where(F.col(c) < value).count() / n, df.where(F.col(c) <= value).count() / n
            assert below - 0.03 <= q <= upto + 0.03
    assert (got["name"].mean, got["name"].approx_q50) == (None, None)
    assert got["name"].approx_distinct == pytest.approx(3000, rel=0.05)


def test_merging_in_steps_and_repeated_batches(spark, tmp_path):
    a, b, c = (I.partial_profile(data(spark, i, i + 500)) for i in (0, 500, 1000))
    steps = I.merge_profiles(I.merge_profiles(a.unionByName(b)).unionByName(c))
    once = I.merge_profiles(a.unionByName(b).unionByName(c))
    for left, right in zip(rows(I.profile_of(steps).select(*EXACT)), rows(I.profile_of(once).select(*EXACT))):
        assert all(x == y or math.isclose(x, y, rel_tol=1e-9) for x, y in zip(left, right))
    store = I.ProfileStore(spark, str(tmp_path / "p"))
    store.add("a", data(spark, 0, 500))
    before = rows(store.profile().select(*EXACT))  # quantile sketches are random
    store.add("a", data(spark, 0, 500))
    assert rows(store.profile().select(*EXACT)) == before
    store.add("b", data(spark, 500, 600))
    assert by_column(store.profile())["few"].rows == 600
    store.drop("b")
    assert rows(store.profile().select(*EXACT)) == before


def test_empty_and_missing(spark):
    df = spark.createDataFrame([(None, None)], "a double, s string")
    got = by_column(I.profile_of(I.merge_profiles(I.partial_profile(df).unionByName(I.partial_profile(df.limit(0))))))
    assert (got["a"].rows, got["a"].null_count, got["a"].mean, got["a"].std, got["a"].approx_q50, got["a"].approx_distinct) == (1, 1, None, None, None, 0)
    empty = by_column(I.profile_of(I.merge_profiles(I.partial_profile(df.limit(0)))))
    assert (empty["s"].rows, empty["s"].null_percent) == (0, None)
