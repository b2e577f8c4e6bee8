"""Nearest places, pivoted counts, distances, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomart.functions.geo import haversine_km
from geomart.operators.columns import normalize_columns
from geomart.operators.knn import geo_center, geo_heat_grid, knn_join
from geomart.operators.mapping import CATEGORY_GROUPS
from geomart.operators.reshape import count_column, left_join_fill, pivot_counts
from geomart.plans.mart import wide_table
from geomart.queries.base import (
    CUSTOMER_AT,
    PART_AT,
    SUPPLIER_AT,
    coords,
    coords_sql,
    distance_sql,
    group_of,
    group_sql,
    null_every,
    null_every_sql,
    query,
    table,
)


def customers(spark, sf):
    lat, lon = coords(*CUSTOMER_AT)
    return table(spark, sf, "customer").select("c_custkey", "c_name", lat.alias("lat"), lon.alias("long"))


def suppliers(spark, sf):
    lat, lon = coords(*SUPPLIER_AT)
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("fsq_id"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        group_of("s_suppkey").alias("category_group"),
    )


def parts(spark, sf):
    lat, lon = coords(*PART_AT)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("fsq_id"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        group_of("p_partkey").alias("category_group"),
    )


def _near_sql(place: str, key: str, at: tuple) -> str:
    la, lo = coords_sql(*CUSTOMER_AT)
    pa, po = coords_sql(*at)
    return f"""
      l AS (SELECT c_custkey, {la} AS la, {lo} AS lo FROM customer),
      p AS (SELECT {key} AS pid, {pa} AS pa, {po} AS po, {group_sql(key)} AS grp FROM {place}),
      d AS (SELECT c_custkey, pid, grp, {distance_sql("la", "lo", "pa", "po")} AS km FROM l, p),
      near AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY km, pid) <= 5)"""


_COUNTS_SQL = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN grp = '{g}' THEN 1 ELSE 0 END), 0) AS INTEGER) AS {count_column(g)}"
    for g in CATEGORY_GROUPS
)


@query(
    "knn_pivot_flagship",
    f"""WITH {_near_sql("supplier", "s_suppkey", SUPPLIER_AT)}
    SELECT c.c_custkey AS publication_key, c_name, {_COUNTS_SQL}
    FROM customer c LEFT JOIN near n ON n.c_custkey = c.c_custkey GROUP BY 1, 2""",
)
def knn_pivot_flagship(spark, sf):
    wide = wide_table(customers(spark, sf), suppliers(spark, sf), 5, listing_id="c_custkey")
    return wide.drop("lat", "long")


@query(
    "knn_join",
    f"""WITH {_near_sql("supplier", "s_suppkey", SUPPLIER_AT)}
    SELECT c_custkey AS listing_id, pid AS place_id, km AS distance_km, grp AS category_group FROM near""",
)
def knn_small(spark, sf):
    return knn_join(customers(spark, sf), suppliers(spark, sf), 5, listing_id="c_custkey")


@query(
    "knn_join_grid",
    f"""WITH {_near_sql("part", "p_partkey", PART_AT)}
    SELECT c_custkey AS listing_id, pid AS place_id, km AS distance_km, grp AS category_group FROM near""",
)
def knn_large(spark, sf):
    return knn_join(customers(spark, sf), parts(spark, sf), 5, listing_id="c_custkey")


_la1, _lo1 = coords_sql("o_custkey", 37, 91)
_la2, _lo2 = coords_sql("l_suppkey", 5347, 7193)


@query(
    "haversine_distance",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, {distance_sql(_la1, _lo1, _la2, _lo2)} AS distance_km
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def haversine_distance(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    at = (*coords("o_custkey", 37, 91), *coords("l_suppkey", 5347, 7193))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select("l_orderkey", "l_linenumber", "l_suppkey", haversine_km(*at).alias("distance_km"))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view", "refund")


@query(
    "pivot_counts",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(count(v) FILTER (event_type = '{t}') AS INTEGER) AS count_{t}" for t in EVENT_TYPES
    )
    + f" FROM (SELECT *, {null_every_sql(3, 'event_id', 'event_id')} AS v FROM events) GROUP BY user_id",
)
def pivot_events(spark, sf):
    """Only values that are not NULL are counted."""
    events = table(spark, sf, "events").withColumn("v", null_every(3, "event_id", F.col("event_id")))
    return pivot_counts(events, "user_id", "event_type", "v", EVENT_TYPES, "count_")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "crosstab",
    "SELECT c_mktsegment, "
    + ", ".join(
        f"CAST(count(*) FILTER (o_orderpriority = '{p}') AS INTEGER) AS {'n_' + p.replace('-', '').replace(' ', '_').lower()}"
        for p in PRIORITIES
    )
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def crosstab(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    segment = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = orders.join(segment, "o_custkey")
    return normalize_columns(pivot_counts(joined, "c_mktsegment", "o_orderpriority", "o_orderkey", PRIORITIES, "n_"))


@query(
    "left_join_fill",
    """SELECT c_custkey, c_name,
      CAST(count(*) FILTER (o_orderstatus = 'F') AS INTEGER) AS "n_F",
      CAST(count(*) FILTER (o_orderstatus = 'O') AS INTEGER) AS "n_O",
      CAST(count(*) FILTER (o_orderstatus = 'P') AS INTEGER) AS "n_P"
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def left_join_counts(spark, sf):
    counts = pivot_counts(table(spark, sf, "orders"), "o_custkey", "o_orderstatus", "o_orderkey", ("F", "O", "P"), "n_")
    return left_join_fill(
        table(spark, sf, "customer").select("c_custkey", "c_name"),
        counts.withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
    )


_cla, _clo = coords_sql(*CUSTOMER_AT)


@query(
    "geo_center",
    f"SELECT round(avg({_cla}), 6) AS center_lat, round(avg({_clo}), 6) AS center_lon FROM customer",
)
def center(spark, sf):
    return geo_center(customers(spark, sf), "lat", "long").select(
        F.round("center_lat", 6).alias("center_lat"), F.round("center_lon", 6).alias("center_lon")
    )


@query(
    "geo_heat_grid",
    f"""SELECT CAST(floor({_cla}/CAST(10 AS DOUBLE)) AS BIGINT) AS cell_lat,
      CAST(floor({_clo}/CAST(10 AS DOUBLE)) AS BIGINT) AS cell_lon, count(*) AS points
    FROM customer GROUP BY 1, 2""",
)
def heat_grid(spark, sf):
    return geo_heat_grid(customers(spark, sf), "lat", "long", 10.0)
