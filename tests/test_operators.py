from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geomart.functions.text import to_number
from geomart.operators import columns as C
from geomart.operators import profile as P
from geomart.operators.dedupe import collect_new, duplicate_count, union_all, work_list
from geomart.operators.keys import category_encode, dense_key, running_total
from geomart.operators.mapping import category_map, category_map_by_table, fuzzy_standardize
from geomart.operators.reshape import count_column, left_join_fill, pivot_counts
from geomart.operators.skew import first_per_key, salted_join, spread_keys


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Host ID` int, `price ($)` int")
    assert C.normalize_columns(df).columns == ["host_id", "price_"]
    with pytest.raises(ValueError, match="host_id"):
        C.normalize_columns(spark.createDataFrame([(1, 2)], "`Host ID` int, `host_id!` int"))


def test_require_columns(spark):
    with pytest.raises(ValueError, match="b"):
        C.require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


def test_membership_and_nulls(spark):
    df = spark.createDataFrame([("NJ",), ("NY",), (None,)], "region string")
    assert rows(C.keep_in(df, "region", ["NJ"])) == [("NJ",)]
    assert rows(C.keep_not_in(df, "region", ["NJ"])) == [(None,), ("NY",)]


def test_drop_where_keeps_unknown(spark):
    df = spark.createDataFrame([(0, None), (0, 1), (None, None)], "n int, d int")
    assert rows(C.drop_where(df, (F.col("n") == 0) & F.col("d").isNull())) == [(None, None), (0, 1)]


def test_parse_integers(spark):
    df = spark.createDataFrame([("1.0", "1.5", None), ("x", "2", None)], "a string, b string, c string")
    loose = C.parse_integers(df, ["a", "b", "c"])
    assert dict(loose.dtypes) == {"a": "bigint", "b": "double", "c": "bigint"}
    assert rows(loose) == [(None, 2.0, None), (1, 1.5, None)]


def test_parse_observed_counts_new_nulls(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("y",)], "a string")
    parsed, made = C.parse_observed(df, {"a": to_number(F.col("a"))})
    assert rows(parsed) == [(None,), (None,), (None,), (1.0,)]
    assert made.get == {"a": 2}


def test_columns_of_type(spark):
    df = spark.createDataFrame([], "a int, b string, c boolean, d date, e timestamp, f decimal(5,2)")
    assert C.columns_of_type(df, "numeric") == ["a", "f"]
    assert C.columns_of_type(df, "datetime") == ["d", "e"]


def test_dense_key_is_gap_free_and_ordered(spark):
    values = list(range(0, 3000, 3))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = sorted((r.v, r.k) for r in dense_key(df, "k", ["v"], start=10).collect())
    assert got == [(v, 10 + i) for i, v in enumerate(sorted(values))]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "zz"]), st.integers(0, 3)), max_size=60))
def test_running_total_with_hot_and_null_keys(spark, items):
    data = [(k, i, w) for i, (k, w) in enumerate(items)]
    df = spark.createDataFrame(data, "k string, i int, w int")
    got = {r.i: r.before for r in running_total(df, ["k", "i"], "before", weight="w").collect()}
    total, want = 0, {}
    for k, i, w in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        want[i] = total
        total += w
    assert got == want


def test_running_total_plan_has_no_single_task_window(spark):
    df = spark.range(1000)
    plan = running_total(df, ["id"], "p")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" not in plan
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(single) == 1  # over the totals, one row per range


def test_equal_order_keys_are_told_apart_by_the_row(spark):
    df = spark.createDataFrame([(1, f"v{i}") for i in range(50)], "o int, v string").repartition(5)
    a = {r.v: r.k for r in dense_key(df, "k", ["o"]).collect()}
    assert sorted(a.values()) == list(range(1, 51))
    assert a == {r.v: r.k for r in dense_key(df.repartition(3), "k", ["o"]).collect()}


def test_category_encode(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert rows(category_encode(df, "v", "code", 3)) == [(None, None), ("a", 0), ("b", 1), ("b", 1)]
    assert {r.code for r in category_encode(df, "v", "code", 2).collect()} == {None}


def test_salted_join_equals_plain_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 20}" if i % 7 else None) for i in range(600)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    hot = spark.createDataFrame([("hot", 4), ("k1", 2), ("absent", 3)], "k string, pieces int")
    for how in ("inner", "left"):
        salted = salted_join(left, right, ["k"], hot, how).select("i", "k", "v")
        assert rows(salted) == rows(left.join(right, "k", how).select("i", "k", "v"))


def test_salt_spreads_equal_rows_and_allows_maps(spark):
    left = spark.range(0, 4000, 1, 4).select(F.lit("hot").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    hot = spark.createDataFrame([("hot", 8)], "k string, pieces int")
    joined = salted_join(left, right, ["k"], hot)
    assert joined.count() == 4000
    assert spread_keys(left, ["k"], hot).select("__salt").distinct().count() == 8


def test_session_splits_skewed_joins(spark):
    """One key on half of the rows, all equal: the join is split by map output."""
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    left = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert left_join_fill(left, right, "k").count() == 20_000


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert rows(first_per_key(df, ["k"], ["v"])) == [("a", 1), ("b", 5)]
    ties = spark.createDataFrame([("a", 1, f"x{i}") for i in range(40)], "k string, v int, w string")
    kept = {first_per_key(ties.repartition(n), ["k"], ["v"]).first().w for n in (1, 3, 8)}
    assert len(kept) == 1
    plan = first_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_category_map_first_list_wins(spark):
    groups = {"restaurants": ["Wine Store", "Deli"], "bars_&_clubs": ["Wine Store", "Bar"]}
    df = spark.createDataFrame([("Wine Store",), ("Bar",), ("Bank",), (None,)], "c string")
    got = {r.c: r.g for r in category_map(df, "c", "g", groups).collect()}
    assert got == {"Wine Store": "restaurants", "Bar": "bars_&_clubs", "Bank": "Other", None: "Other"}


def test_category_map_by_a_table(spark):
    table = spark.createDataFrame([("bars", "Bar", 2), ("food", "Deli", 1), ("bars", "Deli", 2), ("food", None, 1)], "g string, v string, p int")
    df = spark.createDataFrame([("Bar",), ("Deli",), ("Bank",), (None,)], "c string")
    got = {r.c: r.o for r in category_map_by_table(df, "c", "o", table, "g", "v", "p").collect()}
    assert got == {"Bar": "bars", "Deli": "food", "Bank": "Other", None: "Other"}
    big = spark.range(20_000).selectExpr("'g' AS g", "string(id) AS v", "1 AS p")
    assert category_map_by_table(big.select("v"), "v", "o", big, "g", "v", "p").where("o = 'g'").count() == 20_000


def test_fuzzy_standardize(spark):
    names = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]
    df = spark.createDataFrame([(1, "brookln"), (2, "manhatan"), (3, "Paris"), (4, None), (5, "Queens")], "i int, v string")
    got = {r.i: r.v for r in fuzzy_standardize(df, "v", names, 80, "weighted").collect()}
    assert got == {1: "Brooklyn", 2: "Manhattan", 3: "Paris", 4: None, 5: "Queens"}
    best = {r.i: r.b for r in fuzzy_standardize(df, "v", names, None, "levenshtein", "b").collect()}
    assert best[3] in names and best[4] is None


def test_fuzzy_tie_takes_first_choice(spark):
    df = spark.createDataFrame([("ab",)], "v string")
    assert fuzzy_standardize(df, "v", ["ax", "ay"], None, "levenshtein").first().v == "ax"


def test_pivot_and_fill(spark):
    near = spark.createDataFrame([(1, "a_&_b", 7), (1, "a_&_b", 8), (1, "odd", 9), (2, "c d", None)], "id int, g string, p int")
    counts = pivot_counts(near, "id", "g", "p", ["a_&_b", "c d", "none"])
    assert counts.columns == ["id", "count_nearby_a_and_b", "count_nearby_c_d", "count_nearby_none"]
    assert rows(counts) == [(1, 2, 0, 0), (2, 0, 0, 0)]
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows(left_join_fill(left, counts, "id")) == [(1, 2, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert count_column("parks_&_outdoor") == "count_nearby_parks_and_outdoor"


def test_collect_new(spark):
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "k string, t int")
    seen = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows(collect_new(batch, seen, "k", ["t"])) == [("a", 1)]


def test_unions_duplicates_work_list(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(1,)], "i int")
    assert rows(union_all(a, b)) == [(1, None), (1, "x")]
    assert duplicate_count(union_all(a, a, b, b, b)).first()[0] == 3
    assert duplicate_count(a.limit(0)).first()[0] == 0
    areas = spark.createDataFrame([("A",), ("B",)], "area string")
    done = spark.createDataFrame([("A", "x")], "area string, category string")
    assert rows(work_list(areas, "area", ["x", "y"], done)) == [("A", "y"), ("B", "x"), ("B", "y")]


def test_exact_quantiles_match_built_in(spark):
    rng = random.Random(3)
    data = [(float(rng.choice([0, 0, 0, rng.random() * 100])), rng.gauss(0, 5), None) for _ in range(2000)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(shares))]
    for accuracy in (50, 10_000):  # a small sketch brackets, a large one is exact
        table = P.exact_quantiles(df, ["a", "b", "c"], shares, names, accuracy)
        got = {r.column_name: [r[n] for n in names] for r in table.collect()}
        for c in ("a", "b"):
            want = df.select(F.percentile(c, F.array(*[F.lit(s) for s in shares]))).first()[0]
            assert got[c] == pytest.approx(want)
        assert "c" not in got


def test_describe_approx_and_single_row(spark):
    df = spark.createDataFrame([(4.0,)], "a double")
    assert tuple(P.describe_numeric(df, ["a"]).first()) == ("a", 1, 4.0, None, 4.0, 4.0, 4.0, 4.0, 4.0)
    assert P.describe_numeric(df, ["a"], approx=True).first().q50 == 4.0


def test_profile_edges(spark):
    df = spark.createDataFrame([("x", 1), ("y", None), ("y", None), (None, 2), ("x", 2)], "s string, n int")
    assert tuple(P.describe_categorical(df, ["s"]).first()) == ("s", 4, 2, "x", 2)
    assert rows(P.distinct_profile(df, ["s", "n"])) == [("n", 2, 3), ("s", 2, 3)]
    assert rows(P.value_counts(df, "s", with_null=True)) == [(None, 1), ("x", 2), ("y", 2)]
    assert rows(P.top_n_values(df, "s", 1)) == [("x", 2)]
    filled = P.impute_median_mode(df, ["n"], ["s"])
    assert P.impute_median_mode(df, ["n"], []).columns == df.columns
    assert rows(filled) == [("x", 1.0), ("x", 2.0), ("x", 2.0), ("y", 2.0), ("y", 2.0)]


def test_histogram_of_constant_and_empty(spark):
    flat = P.histogram(spark.createDataFrame([(5.0,), (5.0,)], "v double"), "v", 2)
    assert rows(flat) == [(0, 4.5, 5.0, 0), (1, 5.0, 5.5, 2)]
    assert P.histogram(spark.createDataFrame([], "v double"), "v", 3).count() == 0


def test_kde_is_the_row_by_row_density(spark):
    df = spark.range(500).select((F.sin("id") * 10 + F.col("id") / 100).alias("v"))
    values = np.array([r.v for r in df.collect()])
    width = values.std(ddof=1) * len(values) ** -0.2
    curve = P.kde_curve(df, "v").orderBy("x").collect()
    assert len(curve) == 200 and curve[0].x == values.min() and curve[-1].x == pytest.approx(values.max())
    for r in curve:
        exact = np.exp(-0.5 * ((r.x - values) / width) ** 2).mean() / (width * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(exact, rel=1e-9)
    for r in P.kde_curve(df, "v", approx=True).orderBy("x").collect():
        exact = np.exp(-0.5 * ((r.x - values) / width) ** 2).mean() / (width * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(exact, rel=1e-3)


def test_skew_rule(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0)] * 30 + [(100.0, 0.0, 500.0)], "a double, z double, p double")
    got = {r.column_name: r.transform for r in P.skewness_log_rule(df, ["a", "z", "p"]).collect()}
    assert got["a"] == "log1p" and got["p"] == "log"


def test_most_active_year_tie(spark):
    df = spark.sql("SELECT explode(array(date'2021-01-01', date'2020-01-01', NULL)) AS d")
    assert tuple(P.most_active_year(df, "d").first()) == (2020, 1)


def test_fuzzy_standardize_does_not_shuffle_rows_by_few_values(spark):
    names = ["Manhattan", "Brooklyn"]
    df = spark.range(400_000).select("id", *[F.concat(F.lit(f"{c} "), F.col("id").cast("string")).alias(c) for c in "abcd"],
                                     F.when(F.col("id") % 2 == 0, "Manhatan").when(F.col("id") % 3 == 0, "brooklin").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64KB")  # as a large table has with the usual one
    try:
        done = fuzzy_standardize(df, "v", names, 80, "levenshtein")
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r.v: r["count"] for r in done.groupBy("v").count().collect()} == {"Manhattan": 200_000, "brooklin": 66_667, None: 133_333}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
