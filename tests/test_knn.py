from __future__ import annotations

import math
import random

import pytest
from conftest import rows

from geomart.operators.knn import knn_join, with_nearby_counts
from geomart.operators.reshape import left_join_fill, pivot_counts


def brute(listings, places, k):
    def km(a, b):
        la1, lo1, la2, lo2 = map(math.radians, (a[1], a[2], b[1], b[2]))
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        return round(2 * 6371 * math.asin(min(1.0, math.sqrt(h))), 4)

    out = []
    for a in listings:
        if None in a[1:]:
            continue
        near = sorted((km(a, b), b[0], b[3]) for b in places if None not in b[1:3])[:k]
        out += [(a[0], p, d, g) for d, p, g in near]
    return out


def frames(spark, listings, places):
    return (
        spark.createDataFrame(listings, "id int, lat double, long double"),
        spark.createDataFrame(places, "fsq_id int, latitude double, longitude double, category_group string"),
    )


def compare(spark, listings, places, k=5, **shape):
    got = {(r.listing_id, r.place_id): (r.distance_km, r.category_group) for r in knn_join(*frames(spark, listings, places), k, **shape).collect()}
    want = {(i, p): (d, g) for i, p, d, g in brute(listings, places, k)}
    assert got.keys() == want.keys()
    for pair, (d, g) in want.items():
        assert got[pair][1] == g and got[pair][0] == pytest.approx(d, abs=1.1e-4)


def globe(rng):
    return rng.uniform(-90, 90), rng.uniform(-180, 180)


def city(rng):
    return rng.gauss(40.7, 0.05), rng.gauss(-74.0, 0.05)


def seam(rng):
    return rng.choice([(rng.uniform(88, 90), rng.uniform(-180, 180)), (rng.uniform(-10, 10), rng.choice([-180, 180]) + rng.uniform(-1, 1))])


@pytest.mark.parametrize("spread", [globe, city, seam])
@pytest.mark.parametrize("shape", [dict(leaf_size=4, fan_out=3), dict()])
def test_equals_brute_force(spark, spread, shape):
    rng = random.Random(7)
    at = lambda: tuple(max(-180.0, min(180.0, x)) for x in spread(rng))
    listings = [(i, *at()) for i in range(120)] + [(900, *globe(rng)), (901, None, 5.0)]
    places = [(i, *at(), f"g{i % 3}") for i in range(400)] + [(5000, 1.0, None, "g0")]
    compare(spark, listings, places, **shape)


def test_one_spot_holds_a_third_of_both_sides(spark):
    rng = random.Random(5)
    spot = (40.75, -73.99)
    listings = [(i, *(spot if i % 3 == 0 else city(rng))) for i in range(150)]
    places = [(i, *(spot if i % 3 == 0 else city(rng)), "g") for i in range(300)]
    random.Random(1).shuffle(places)
    compare(spark, listings, places, leaf_size=5, fan_out=4)


def test_counts_equal_join_pivot_and_fill(spark):
    rng = random.Random(11)
    listings = [(i, *(city(rng) if i % 4 else (40.7, -74.0))) for i in range(60)] + [(99, None, 1.0)]
    places = [(i, *city(rng), ("restaurants", "parks_&_outdoor", "Other")[i % 3]) for i in range(80)]
    left, right = frames(spark, listings, places)
    groups = ["restaurants", "parks_&_outdoor", "landmarks"]
    pivoted = pivot_counts(knn_join(left, right, 4), "listing_id", "category_group", "place_id", groups)
    want = left_join_fill(left, pivoted.withColumnRenamed("listing_id", "id"), "id")
    got = with_nearby_counts(left, right, 4, groups)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert [tuple(r)[3:] for r in got.where("id = 99").collect()] == [(0, 0, 0)]


def test_fewer_places_than_k(spark):
    listings, places = [(1, 0.0, 0.0), (2, 10.0, 10.0)], [(1, 0.0, 1.0, "a"), (2, 0.0, -1.0, "b")]
    compare(spark, listings, places, k=5)
    assert rows(knn_join(*frames(spark, listings, places), 1)) == [(1, 1, 111.1949, "a"), (2, 1, pytest.approx(1495.7, abs=10), "a")]


def test_no_places(spark):
    assert knn_join(*frames(spark, [(1, 0.0, 0.0)], []), 3).count() == 0


def test_plan_has_no_all_pairs_join(spark):
    rng = random.Random(2)
    listings, places = [(i, *globe(rng)) for i in range(50)], [(i, *globe(rng), "g") for i in range(200)]
    plan = knn_join(*frames(spark, listings, places), 3, leaf_size=4, fan_out=4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
