from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from geomart.operators import star as M
from geomart.plans.cleaning import clean_listings, clean_places
from geomart.plans.mart import run
from geomart.sources.tables import FolderTables

NAMES = [
    "id", "NAME", "host id", "host_identity_verified", "host name", "neighbourhood group", "neighbourhood", "lat", "long",
    "country", "instant_bookable", "cancellation_policy", "room type", "Construction year", "price", "service fee",
    "minimum nights", "number of reviews", "last review", "reviews per month", "review rate number",
    "calculated host listings count", "availability 365",
]


def listing(i, **changes):
    row = dict(zip(NAMES, [
        str(i), f" Room {i} ", "77", "verified", "Ann", "brookln", "Kensington", "40.6", "-73.9", "US", "TRUE", "strict",
        "Private room", "2020", "$966 ", "$1,193 ", "10", "9", "10/19/2021", "0.21", "4", "6", "286",
    ]))
    row.update(changes)
    return tuple(row[n] for n in NAMES)


def raw_listings(spark, items):
    return spark.createDataFrame(items, ", ".join(f"`{n}` string" for n in NAMES))


def raw_places(spark):
    data = [
        ("c", "Deli One", 40.61, -73.91, "Deli", "NY"),
        ("a", "Far", 10.0, 10.0, "Museum", "NJ"),
        ("b", "Park", 40.62, -73.92, "Park", None),
    ]
    return spark.createDataFrame(data, "fsq_id string, name string, latitude double, longitude double, category_main_name string, region string")


GROUPS = {"cultural": ["Museum"], "restaurants": ["Deli"], "parks_&_outdoor": ["Park"]}


def test_clean_listings(spark):
    items = [
        listing(1),
        listing(2, NAME="nan", **{"host name": None, "price": None, "service fee": "x", "last review": None, "host_identity_verified": None, "instant_bookable": "no"}),
        listing(3, lat=None),
        listing(4, **{"number of reviews": None, "last review": None, "review rate number": None}),
        listing(5, **{"review rate number": "x"}),
        listing(6, **{"Construction year": None, "minimum nights": "nan", "availability 365": "", "cancellation_policy": "None"}),
    ]
    got = {r.id: r for r in clean_listings(raw_listings(spark, items)).collect()}
    assert set(got) == {1, 2, 6}
    assert (got[1].name, got[1].neighbourhood_group, got[1].price, got[1].service_fee) == ("Room 1", "Brooklyn", 966.0, 1193.0)
    assert (got[1].host_verification, got[1].instant_bookable_flag, str(got[1].last_review)) == (True, True, "2021-10-19")
    assert (got[2].name, got[2].host_name, got[2].price, got[2].service_fee) == ("no_name", "unknown_host", 624.0, 125.0)
    assert (got[2].host_verification, got[2].instant_bookable_flag, str(got[2].last_review)) == (False, False, "2262-04-11")
    assert (got[6].construction_year, got[6].minimum_nights, got[6].availability_365, got[6].cancellation_policy) == (2012, 3, 96, "moderate")


def test_readable_fractions_stay(spark):
    items = [listing(1, **{"minimum nights": "2.5"}), listing(2)]
    got = {r.id: r.minimum_nights for r in clean_listings(raw_listings(spark, items)).collect()}
    assert got == {1: 2.5, 2: 10.0}


def test_position_keys_are_given_before_rows_are_dropped(spark):
    items = [listing(30), listing(10, lat=None), listing(20)]
    got = clean_listings(raw_listings(spark, items), order_by=["id"])
    assert rows(got.select("id", "host_id")) == [(2, 150001), (3, 150002)]


def test_clean_places(spark):
    assert rows(clean_places(raw_places(spark), GROUPS).select("fsq_id", "category_group")) == [(1, "parks_&_outdoor"), (2, "restaurants")]
    kept = clean_places(raw_places(spark), GROUPS, exclude=False)
    assert kept.columns == ["latitude", "longitude", "category_group", "fsq_id"] and kept.count() == 1


def test_run_end_to_end(spark, tmp_path):
    items = [listing(i, lat=str(40.6 + i / 100), **{"host id": str(i % 2)}) for i in range(1, 6)]
    target = FolderTables(spark, str(tmp_path / "mart"))
    args = raw_listings(spark, items), raw_places(spark), GROUPS, target, str(tmp_path / "topic")
    run(*args, k=2)
    run(*args, k=2)
    fact = target.read("fact_publication")
    assert fact.count() == 5 and target.read("dim_host").count() == 2
    assert fact.where("host_key IS NULL OR property_location_key IS NULL OR property_key IS NULL").count() == 0
    assert fact.agg(F.sum("count_nearby_restaurants"), F.sum("count_nearby_parks_and_outdoor")).first() == (5, 5)
    assert rows(target.read("dim_date").select("date_key", "day_of_week")) == [(20211019, "Tuesday")]
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 10


def test_empty_input_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="places"):
        run(raw_listings(spark, [listing(1)]), raw_places(spark).limit(0), GROUPS, FolderTables(spark, str(tmp_path)))


def test_verified_flag(spark):
    df = spark.createDataFrame([("Verified",), ("false",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(M.verified_flag(F.col("v"))).collect()] == [True, True, False, False]
    flags = spark.createDataFrame([(True, 0), (False, 2), (None, None)], "b boolean, n int")
    got = flags.select(M.verified_flag(F.col("b")), M.verified_flag(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False)]


def test_upsert_dimension(spark):
    dim = spark.createDataFrame([(1, 10, "a"), (7, 20, "b")], "host_key bigint, host_id int, host_name string")
    new = spark.createDataFrame([(20, "x", 1), (30, "late", 2), (30, "first", 1), (25, "y", 1)], "host_id int, host_name string, t int")
    got = M.upsert_dimension(dim, new, ["host_id"], "host_key", ["t"])
    assert rows(got) == [(1, 10, "a"), (7, 20, "b"), (8, 25, "y"), (9, 30, "first")]
    assert rows(M.upsert_dimension(got, new, ["host_id"], "host_key", ["t"])) == rows(got)


def test_dim_date_leaves_out_bad_numbers(spark):
    df = spark.createDataFrame([(20240229,), (20240229,), (20241399,), (None,)], "last_review int")
    assert rows(M.dim_date(df)) == [(20240229, *rows(M.dim_date(df))[0][1:2], 2024, 2, 29, "Thursday", "February")]


def wide(spark, items):
    counts = ", ".join(f"0 AS {M.count_column(g)}" for g in M.CATEGORY_GROUPS)
    df = spark.createDataFrame(items, "publication_key long, host_id long, neighbourhood string, lat double, last_review int")
    return df.selectExpr(
        "*", "'n' AS name", "'h' AS host_name", "true AS host_verification", "1 AS calculated_host_listings_count",
        "'g' AS neighbourhood_group", "-73.5 AS long", "'true' AS instant_bookable_flag", "'c' AS cancellation_policy",
        "'r' AS room_type", "2020 AS construction_year", "1.0 AS price", "1.0 AS service_fee", "1 AS minimum_nights",
        "1 AS number_of_reviews", "1.0 AS reviews_per_month", "1 AS review_rate_number", "1 AS availability_365", counts.split(", ")[0],
        *counts.split(", ")[1:],
    )


def test_null_keys(spark):
    star = M.build_star(wide(spark, [(1, 7, None, 40.0, 20240101), (2, None, "x", 40.0, 20240101)]))
    assert rows(star["dim_host"].select("host_key", "host_id")) == [(1, 7)]
    fact = {r.property_key: r for r in star["fact_publication"].collect()}
    assert fact[2].host_key is None and fact[1].property_location_key is not None  # a NULL part of a composite key matches
    dim = spark.createDataFrame([(1, 10, "a")], "host_key bigint, host_id int, host_name string")
    new = spark.createDataFrame([(None, "x", 1), (11, "y", 1)], "host_id int, host_name string, t int")
    once = M.upsert_dimension(dim, new, ["host_id"], "host_key", ["t"])
    assert rows(once) == rows(M.upsert_dimension(once, new, ["host_id"], "host_key", ["t"])) == [(1, 10, "a"), (2, 11, "y")]
    pairs = spark.createDataFrame([(1, "a", None)], "k bigint, g string, n string")
    more = spark.createDataFrame([("a", None), ("b", None), (None, None)], "g string, n string")
    assert rows(M.upsert_dimension(pairs, more, ["g", "n"], "k", ["g"])) == [(1, "a", None), (2, "b", None)]


def test_append_facts(spark):
    first, second = [(1, 7, "x", 40.0, 20240101), (2, 8, "y", 41.0, 20240102)], [(3, 7, "z", 42.0, 20240103), (4, 9, "x", 40.0, 20240101)]
    star = M.append_facts(wide(spark, second), M.build_star(wide(spark, first)))
    assert {n: t.count() for n, t in star.items()} == {
        "dim_host": 3, "dim_property_location": 3, "dim_property": 4, "dim_date": 3, "fact_publication": 4,
    }
    assert rows(star["dim_host"].select("host_key", "host_id")) == [(1, 7), (2, 8), (3, 9)]
    for bad, said in (
        ([(1, 7, "x", 40.0, 20240101)], "already"),
        ([(5, 7, "x", 40.0, 20240101)] * 2, "twice"),
        ([(5, None, "x", 40.0, 20240101)], "host_key"),
        ([(5, 7, "x", None, 20240101)], "property_location_key"),
        ([(5, 7, "x", 40.0, 20241399)], "dim_date"),
    ):
        with pytest.raises(M.LoadError, match=said):
            M.append_facts(wide(spark, bad), star)
