from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from geomart.functions import dates as D
from geomart.functions import fuzzy as Z
from geomart.functions import geo as G
from geomart.functions import text as X


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [(" a ", "a"), ("nan", None), (" None ", None), ("\t", None), ("", None), (None, None), ("none", "none"), (" x ", "x")],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, X.clean_text) == want


@pytest.mark.parametrize(
    "raw, want",
    [("1.5", 1.5), (" 7 ", 7.0), ("1e3", 1000.0), ("nan", None), ("NaN", None), ("1.0d", None), ("2f", None), ("x", None), (None, None), ("-.5", -0.5)],
)
def test_to_number(spark, raw, want):
    assert one(spark, raw, X.to_number) == want


@pytest.mark.parametrize("raw, want", [("3.0", 3), ("3.5", None), ("x", None), ("-4", -4), (None, None)])
def test_to_whole_number(spark, raw, want):
    assert one(spark, raw, X.to_whole_number) == want


@pytest.mark.parametrize("raw, want", [("$1,060 ", 1060.0), ("$", None), ("12", 12.0), (None, None), ("free", None)])
def test_parse_currency(spark, raw, want):
    assert one(spark, raw, X.parse_currency) == want


def test_flags(spark):
    names = {"verified": True, "unconfirmed": False}
    assert [one(spark, v, lambda c: X.flag_from_map(c, names)) for v in ("verified", "unconfirmed", "Verified", None)] == [True, False, None, None]
    assert [one(spark, v, X.flag_from_text) for v in ("TRUE", "false", "yes", None)] == [True, False, None, None]
    assert [one(spark, v, X.is_true_text) for v in ("True", "no", None)] == [True, False, False]


def test_text_parts(spark):
    assert one(spark, "Café & Bar, 5th\nAve!", X.keep_letters_digits) == "Caf  Bar 5th\nAve"
    assert one(spark, "1 Main St, Bronx, NY", X.drop_comma_space) == "1 Main StBronxNY"
    assert one(spark, "Bronx, NY", X.first_part) == "Bronx"
    assert one(spark, ["a", "b"], X.join_parts, "array<string>") == "a, b"


def test_dates(spark):
    day = lambda c: D.parse_date(c).cast("string")
    assert [one(spark, v, day) for v in ("10/19/2021", "1/2/2020", "13/45/2020", "x", None)] == ["2021-10-19", "2020-01-02", None, None, None]
    assert one(spark, "2021-03-04", lambda c: D.date_key(c.cast("date"))) == 20210304
    assert one(spark, None, lambda c: D.date_key(D.fill_sentinel(c.cast("date")))) == D.SENTINEL_KEY
    iso = [one(spark, v, D.iso_utc_from_key, "int") for v in (20210304, 22620411, 20201399, None)]
    assert iso == ["2021-03-04T00:00:00Z", None, None, None]
    parts = spark.range(1).select(*[e.alias(n) for n, e in D.date_parts(F.lit("2024-02-29").cast("date")).items()]).first()
    assert tuple(parts) == (2024, 2, 29, "Thursday", "February")


def test_haversine(spark):
    def km(*at):
        return spark.range(1).select(G.haversine_km(*(F.lit(float(x)) for x in at))).first()[0]

    assert km(0, 0, 0, 0) == 0
    assert km(0, 0, 0, 180) == round(math.pi * 6371, 4)
    assert km(90, 10, 90, -170) == 0
    assert km(40.7128, -74.006, 40.7306, -73.9352) == pytest.approx(6.2863, abs=1e-3)


def test_hilbert_position_is_a_walk(spark):
    """Every cell of a small grid has its own number, and neighbours in number touch."""
    n = 8
    grid = [((y + 0.5) / n * 180 - 90, (x + 0.5) / n * 360 - 180, x, y) for x in range(n) for y in range(n)]
    df = spark.createDataFrame(grid, "lat double, lon double, x int, y int")
    got = df.select(G.hilbert_position(F.col("lat"), F.col("lon"), bits=3).alias("d"), "x", "y").orderBy("d").collect()
    assert [r.d for r in got] == list(range(n * n))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(got, got[1:]))


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("brookln", "Brooklyn", 80.0),  # 6 shared letters: 200*6/15
        ("manhatan", "manhattan", 200 * 8 / 17),
        ("new york mets", "mets new york", 95.0),  # same words, other order
        ("Queens", "Queens borough", 90.0),  # part of a longer text
        ("abc", "xyz", 0.0),
        ("", "abc", 0.0),
    ],
)
def test_weighted_score(spark, a, b, want):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(Z.weighted_ratio(F.col("a"), F.col("b"))).first()[0]
    assert got == pytest.approx(want, abs=1e-9)


def test_other_scores(spark):
    pairs = spark.createDataFrame([("brookln", "Brooklyn"), ("a", None)], "a string, b string")
    got = pairs.select(Z.indel_ratio(F.col("a"), F.col("b")), Z.levenshtein_ratio(F.col("a"), F.col("b"))).collect()
    assert tuple(got[0]) == (80.0, 75.0)
    assert tuple(got[1]) == (None, None)


def test_typed_numbers_take_no_way_through_text(spark):
    df = spark.createDataFrame([(1.5, 7), (float("nan"), None), (float("-inf"), -3), (-0.0, 2**60), (None, 0)], "d double, n long")
    typed = df.select(*[X.to_number(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns])
    assert "translate" not in typed._jdf.queryExecution().executedPlan().toString()
    text = df.select(*[X.to_number(F.col(c)).alias(c) for c in df.columns])
    assert typed.collect() == text.collect()
    assert [r.d for r in typed.collect()] == [1.5, None, None, 0.0, None]
