"""Exact k nearest places of every listing, by great-circle distance.

The places are put in Hilbert order and cut into leaves of equal size; boxes around the
leaves, around groups of leaves and so on form a packed R-tree held in DataFrames. A
listing starts at the top boxes, at most ``fan_out`` of them, and goes down by equi-joins
on the box number; the upper levels are small enough for Spark to broadcast by their size.
A box is left out only when its nearest point is farther than a distance within which k
places are known to lie, so the result is exact. Every box has the same number of children
and every leaf the same number of places, however the places cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomart.functions.geo import grid_cell, haversine_km, hilbert_position, unit_vector
from geomart.operators.keys import running_total
from geomart.operators.reshape import count_column
from geomart.operators.skew import first_per_key
from geomart.session import materialize

AXES = ("x", "y", "z")
# Two distances that round to the same 4 decimals of a km differ by less than 1e-4 km, which
# is 1.6e-8 on the unit sphere; boxes and places up to this much farther are kept.
TIE_MARGIN = 2e-8


def _boxes(df: DataFrame, node: Column, first: bool) -> DataFrame:
    low = [F.min(a if first else f"{a}_lo").alias(f"{a}_lo") for a in AXES]
    high = [F.max(a if first else f"{a}_hi").alias(f"{a}_hi") for a in AXES]
    size = F.count(F.lit(1)) if first else F.sum("n")
    return df.groupBy(node.alias("node")).agg(*low, *high, size.alias("n"))


def _root(parts: list[Column]) -> Column:
    return F.sqrt(parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2])


def _nearest() -> Column:
    return _root([F.greatest(F.col(f"{a}_lo") - F.col(a), F.col(a) - F.col(f"{a}_hi"), F.lit(0.0)) for a in AXES])


def _farthest() -> Column:
    return _root([F.greatest(F.col(a) - F.col(f"{a}_lo"), F.col(f"{a}_hi") - F.col(a)) for a in AXES])


def _tighten(front: DataFrame, k: int) -> DataFrame:
    """Drop the boxes of each point that cannot hold one of its k nearest places."""
    at_point = Window.partitionBy("lat", "lon")
    near_enough = F.col("near") <= F.col("radius") + TIE_MARGIN
    return (
        front.withColumn("near", _nearest())
        .where(near_enough)
        .withColumn("reach", F.min(F.when(F.col("n") >= k, _farthest())).over(at_point))
        .withColumn("radius", F.least("radius", "reach"))
        .where(near_enough)
        .select("lat", "lon", *AXES, "node", "radius")
    )


def nearest_per_spot(
    listings: DataFrame,
    places: DataFrame,
    k: int = 5,
    *,
    listing_at: tuple[str, str] = ("lat", "long"),
    place_id: str = "fsq_id",
    place_at: tuple[str, str] = ("latitude", "longitude"),
    carry: tuple[str, ...] = ("category_group",),
    leaf_size: int = 16,
    fan_out: int = 16,
) -> DataFrame:
    """(lat, lon, near): for each distinct listing spot its ``k`` nearest places as an array.

    An item of ``near`` is (place_id, distance_km, *carry). Ties go to the smaller place id.
    With fewer than ``k`` places all of them are returned.
    """
    leaf_size = max(leaf_size, k)
    # Places at one spot tie with each other: only the k smallest ids can be among the nearest.
    spots = places.select(
        F.col(place_at[0]).cast("double").alias("p_lat"),
        F.col(place_at[1]).cast("double").alias("p_lon"),
        F.col(place_id).alias("place_id"),
        *carry,
    ).dropna(subset=["p_lat", "p_lon"])
    spots = first_per_key(spots, ["p_lat", "p_lon"], ["place_id"], k)
    for axis, c in zip(AXES, unit_vector(F.col("p_lat"), F.col("p_lon"))):
        spots = spots.withColumn(axis, c)
    spots = spots.withColumn("curve", hilbert_position(F.col("p_lat"), F.col("p_lon")))
    ranked = running_total(spots, ["curve", "place_id"], "position").withColumn(
        "node", F.floor(F.col("position") / leaf_size)
    )
    ranked = materialize(ranked.drop("position", "curve"), "knn-places")

    n_nodes = -(-ranked.count() // leaf_size)
    leaves = materialize(_boxes(ranked, F.col("node"), first=True), "knn-boxes")
    levels = [leaves]
    while n_nodes > fan_out:
        levels.append(_boxes(leaves, F.floor(F.col("node") / fan_out ** len(levels)), first=False))
        n_nodes = -(-n_nodes // fan_out)
    top = levels[-1].collect()  # at most fan_out rows
    box_type = "array<struct<" + ",".join(f"{n}:{t}" for n, t in levels[-1].dtypes) + ">>"
    top_boxes = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in row.asDict().items()]) for row in top])

    # One search per distinct spot, however many listings share it.
    points = (
        listings.select(
            F.col(listing_at[0]).cast("double").alias("lat"), F.col(listing_at[1]).cast("double").alias("lon")
        )
        .dropna()
        .distinct()
    )
    # Small rows that open into hundreds of pairs each: keep the full number of tasks.
    tasks = int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = points.repartition(tasks, "lat", "lon")
    for axis, c in zip(AXES, unit_vector(F.col("lat"), F.col("lon"))):
        points = points.withColumn(axis, c)
    front = points.select("lat", "lon", *AXES, F.inline(top_boxes.cast(box_type)))
    front = _tighten(front.withColumn("radius", F.lit(float("inf"))), k)
    for boxes in reversed(levels[:-1]):
        children = boxes.withColumnRenamed("node", "child").withColumn("node", F.floor(F.col("child") / fan_out))
        front = _tighten(front.join(children, "node").drop("node").withColumnRenamed("child", "node"), k)

    place = ranked.select("node", "place_id", "p_lat", "p_lon", *carry, *[F.col(a).alias(f"p_{a}") for a in AXES])
    chord = _root([F.col(a) - F.col(f"p_{a}") for a in AXES])
    pairs = (
        front.join(place, "node")
        .where(chord <= F.col("radius") + TIE_MARGIN)
        .select(
            "lat",
            "lon",
            haversine_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")).alias("distance_km"),
            "place_id",
            *carry,
        )
    )
    nearest = first_per_key(pairs, ["lat", "lon"], ["distance_km", "place_id"], k)
    return nearest.groupBy("lat", "lon").agg(
        F.collect_list(F.struct("place_id", "distance_km", *carry)).alias("near")  # at most k
    )


def _spot(at: tuple[str, str]) -> dict[str, Column]:
    return {"__lat": F.col(at[0]).cast("double"), "__lon": F.col(at[1]).cast("double")}


def knn_join(
    listings: DataFrame,
    places: DataFrame,
    k: int = 5,
    *,
    listing_id: str = "id",
    listing_at: tuple[str, str] = ("lat", "long"),
    **search,
) -> DataFrame:
    """(listing_id, place_id, distance_km, *carry), ``k`` rows per listing with coordinates.

    ``search`` goes to ``nearest_per_spot``.
    """
    near = nearest_per_spot(listings, places, k, listing_at=listing_at, **search)
    keyed = listings.withColumns(_spot(listing_at)).select(F.col(listing_id).alias("listing_id"), "__lat", "__lon")
    joined = keyed.join(near.toDF("__lat", "__lon", "near"), ["__lat", "__lon"])
    return joined.select("listing_id", F.inline("near"))


def with_nearby_counts(
    listings: DataFrame,
    places: DataFrame,
    k: int,
    groups: Sequence[str],
    *,
    group: str = "category_group",
    listing_at: tuple[str, str] = ("lat", "long"),
    **search,
) -> DataFrame:
    """Listings plus, per group, how many of their ``k`` nearest places belong to it.

    Equals ``knn_join``, ``pivot_counts`` and ``left_join_fill`` in a row, but counts inside
    the array of neighbours: one join to the listings and no shuffle after it.
    """

    def belongs_to(name: str):
        return lambda place: place[group] == name

    near = nearest_per_spot(listings, places, k, listing_at=listing_at, carry=(group,), **search)
    counts = near.select(
        F.col("lat").alias("__lat"),
        F.col("lon").alias("__lon"),
        *[F.size(F.filter("near", belongs_to(g))).alias(count_column(g)) for g in groups],
    )
    joined = listings.withColumns(_spot(listing_at)).join(counts, ["__lat", "__lon"], "left")
    return joined.select(*listings.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in map(count_column, groups)])


def geo_center(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.agg(F.avg(lat).alias("center_lat"), F.avg(lon).alias("center_lon"))


def geo_heat_grid(df: DataFrame, lat: str, lon: str, step: float) -> DataFrame:
    """Number of points per grid cell; a cell is named by its lower corner."""
    return (
        df.dropna(subset=[lat, lon])
        .groupBy(grid_cell(F.col(lat), step).alias("cell_lat"), grid_cell(F.col(lon), step).alias("cell_lon"))
        .agg(F.count(F.lit(1)).alias("points"))
    )
