"""Dimensions, facts, loads. Orders stand in for the wide listings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomart.operators.keys import dense_key
from geomart.operators.mapping import CATEGORY_GROUPS
from geomart.operators.reshape import count_column
from geomart.operators.quality import broken_keys
from geomart.operators.star import (
    LOAD_ORDER,
    LOCATION_KEY,
    MEASURES,
    PROPERTY_COLUMNS,
    build_star,
    dim_date,
    dim_host,
    dim_location,
    dim_property,
    upsert_dimension,
)
from geomart.queries.base import coords, coords_sql, null_every, null_every_sql, query, table
from geomart.session import scratch_path
from geomart.sources.star_store import StarStore
from geomart.sources.tables import load_star

_lat, _lon = coords_sql("o_custkey", 37, 91)
_counts = [count_column(g) for g in CATEGORY_GROUPS]

WIDE_SQL = f"""(SELECT o_orderkey AS publication_key, 'Room ' || o_orderpriority AS name, o_custkey AS host_id,
  'Host ' || o_orderpriority AS host_name, o_orderstatus <> 'P' AS host_verification,
  o_custkey % 10 AS calculated_host_listings_count, o_orderpriority AS neighbourhood_group,
  o_orderstatus AS neighbourhood, {_lat} AS lat, {_lon} AS long,
  CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'no' END AS instant_bookable_flag, 'strict' AS cancellation_policy,
  'Private room' AS room_type, o_orderkey % 20 + 2003 AS construction_year,
  CASE WHEN o_orderkey % 6 <> 0 THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) ELSE 22620411 END AS last_review,
  o_totalprice AS price, o_totalprice / 8 AS service_fee, o_orderkey % 30 AS minimum_nights,
  o_orderkey % 40 AS number_of_reviews, (o_orderkey % 7) / 2.0::DOUBLE AS reviews_per_month,
  o_orderkey % 5 + 1 AS review_rate_number, o_orderkey % 366 AS availability_365,
  {", ".join(f"CAST((o_orderkey + {i}) % 6 AS INTEGER) AS {c}" for i, c in enumerate(_counts))} FROM orders)"""


def wide_listings(spark, sf):
    k = F.col("o_orderkey")
    lat, lon = coords("o_custkey", 37, 91)
    return table(spark, sf, "orders").select(
        k.alias("publication_key"),
        F.concat(F.lit("Room "), "o_orderpriority").alias("name"),
        F.col("o_custkey").alias("host_id"),
        F.concat(F.lit("Host "), "o_orderpriority").alias("host_name"),
        (F.col("o_orderstatus") != "P").alias("host_verification"),
        (F.col("o_custkey") % 10).alias("calculated_host_listings_count"),
        F.col("o_orderpriority").alias("neighbourhood_group"),
        F.col("o_orderstatus").alias("neighbourhood"),
        lat.alias("lat"),
        lon.alias("long"),
        F.when(k % 2 == 0, "True").otherwise("no").alias("instant_bookable_flag"),
        F.lit("strict").alias("cancellation_policy"),
        F.lit("Private room").alias("room_type"),
        (k % 20 + 2003).alias("construction_year"),
        F.when(k % 6 != 0, F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
        .otherwise(F.lit(22620411))
        .alias("last_review"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") / 8).alias("service_fee"),
        (k % 30).alias("minimum_nights"),
        (k % 40).alias("number_of_reviews"),
        (k % 7 / F.lit(2.0)).alias("reviews_per_month"),
        (k % 5 + 1).alias("review_rate_number"),
        (k % 366).alias("availability_365"),
        *[((k + i) % 6).cast("int").alias(c) for i, c in enumerate(_counts)],
    )


HOST_SQL = f"""(SELECT row_number() OVER (ORDER BY host_id) AS host_key, host_id, host_name, host_verification,
  calculated_host_listings_count FROM (SELECT * FROM {WIDE_SQL}
  QUALIFY row_number() OVER (PARTITION BY host_id ORDER BY publication_key) = 1))"""


@query("dim_host", f"SELECT * FROM {HOST_SQL}")
def host(spark, sf):
    return dim_host(wide_listings(spark, sf), ["publication_key"])


LOCATION_SQL = f"""(SELECT row_number() OVER (ORDER BY g, h, la, lo) AS property_location_key,
  g AS listing_neighbourhood_group, h AS listing_neighbourhood, la AS listing_lat, lo AS listing_long
  FROM (SELECT DISTINCT neighbourhood_group AS g, neighbourhood AS h, CAST(lat AS DECIMAL(10,7)) AS la,
    CAST(long AS DECIMAL(10,7)) AS lo FROM {WIDE_SQL}))"""


def _plain(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("listing_lat", "listing_long")})


@query(
    "dim_location",
    f"SELECT * REPLACE (CAST(listing_lat AS DOUBLE) AS listing_lat, CAST(listing_long AS DOUBLE) AS listing_long) FROM {LOCATION_SQL}",
)
def location(spark, sf):
    return _plain(dim_location(wide_listings(spark, sf)))


PROPERTY_SQL = f"""(SELECT row_number() OVER (ORDER BY publication_key) AS property_key, publication_key,
  name AS property_name, lower(instant_bookable_flag) = 'true' AS instant_bookable_flag, cancellation_policy, room_type,
  construction_year FROM {WIDE_SQL})"""


@query("dim_property", f"SELECT * FROM {PROPERTY_SQL}")
def prop(spark, sf):
    return dim_property(wide_listings(spark, sf))


DATE_SQL = f"""(SELECT DISTINCT last_review AS date_key, strptime(CAST(last_review AS VARCHAR), '%Y%m%d') AS d
  FROM {WIDE_SQL})"""


@query(
    "dim_date",
    f"""SELECT date_key, strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS INTEGER) AS year,
      CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, strftime(d, '%A') AS day_of_week,
      strftime(d, '%B') AS month_name FROM {DATE_SQL}""",
)
def dates(spark, sf):
    return dim_date(wide_listings(spark, sf)).withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


_measures = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)
FACT_SQL = f"""(SELECT p.property_key, h.host_key, l.property_location_key, w.last_review AS last_review_date_key,
  {_measures}, {", ".join(_counts)} FROM {WIDE_SQL} w
  LEFT JOIN {HOST_SQL} h ON h.host_id = w.host_id
  LEFT JOIN {LOCATION_SQL} l ON l.listing_neighbourhood_group = w.neighbourhood_group
    AND l.listing_neighbourhood = w.neighbourhood AND l.listing_lat = CAST(w.lat AS DECIMAL(10,7))
    AND l.listing_long = CAST(w.long AS DECIMAL(10,7))
  LEFT JOIN {PROPERTY_SQL} p ON p.publication_key = w.publication_key)"""


@query("fact_build", f"SELECT * FROM {FACT_SQL}")
def fact(spark, sf):
    return build_star(wide_listings(spark, sf))["fact_publication"]


@query(
    "dim_upsert",
    f"""WITH old AS (SELECT row_number() OVER (ORDER BY c_custkey) AS host_key, c_custkey AS host_id, c_name AS host_name
        FROM customer WHERE c_acctbal > 0),
      wide AS (SELECT * REPLACE ({null_every_sql(7, "publication_key", "host_id")} AS host_id) FROM {WIDE_SQL}),
      new AS (SELECT host_id, host_name FROM wide WHERE host_id IS NOT NULL AND host_id NOT IN (SELECT host_id FROM old)
        QUALIFY row_number() OVER (PARTITION BY host_id ORDER BY publication_key) = 1)
    SELECT * FROM old UNION ALL
    SELECT (SELECT max(host_key) FROM old) + row_number() OVER (ORDER BY host_id), host_id, host_name FROM new""",
)
def upsert(spark, sf):
    old = table(spark, sf, "customer").where("c_acctbal > 0")
    old = old.select(F.col("c_custkey").alias("host_id"), F.col("c_name").alias("host_name"))
    old = dense_key(old, "host_key", ["host_id"]).select("host_key", "host_id", "host_name")
    wide = wide_listings(spark, sf)
    wide = wide.withColumn("host_id", null_every(7, "publication_key", F.col("host_id")))
    once = upsert_dimension(old, wide, ["host_id"], "host_key", ["publication_key"])
    return upsert_dimension(once, wide, ["host_id"], "host_key", ["publication_key"])  # twice equals once


@query(
    "star_query",
    f"""SELECT year(d.d)::INTEGER AS year, l.listing_neighbourhood_group, h.host_verification, count(*) AS n,
      round(sum(f.price), 2) AS price, CAST(sum(f.count_nearby_landmarks) AS BIGINT) AS landmarks
    FROM {FACT_SQL} f JOIN {HOST_SQL} h USING (host_key) JOIN {LOCATION_SQL} l USING (property_location_key)
    JOIN {DATE_SQL} d ON d.date_key = f.last_review_date_key GROUP BY 1, 2, 3""",
)
def star(spark, sf):
    tables = build_star(wide_listings(spark, sf))
    joined = (
        tables["fact_publication"]
        .join(tables["dim_host"], "host_key")
        .join(tables["dim_property_location"], "property_location_key")
        .join(tables["dim_date"].withColumnRenamed("date_key", "last_review_date_key"), "last_review_date_key")
    )
    return joined.groupBy("year", "listing_neighbourhood_group", "host_verification").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("price"), 2).alias("price"),
        F.sum("count_nearby_landmarks").alias("landmarks"),
    )


@query(
    "truncate_and_load",
    f"""SELECT 'dim_host' AS table_name, host_key AS key, concat_ws('|', host_id, host_name, host_verification,
      calculated_host_listings_count) AS held FROM {HOST_SQL} UNION ALL
    SELECT 'dim_property_location', property_location_key, concat_ws('|', listing_neighbourhood_group, listing_neighbourhood,
      listing_lat, listing_long) FROM {LOCATION_SQL} UNION ALL
    SELECT 'dim_property', property_key, concat_ws('|', publication_key, property_name, instant_bookable_flag,
      cancellation_policy, room_type, construction_year) FROM {PROPERTY_SQL} UNION ALL
    SELECT 'dim_date', date_key, strftime(d, '%Y-%m-%d|%A|%B') FROM {DATE_SQL} UNION ALL
    SELECT 'fact_publication', property_key, concat_ws('|', host_key, property_location_key, last_review_date_key,
      minimum_nights::BIGINT, {", ".join(_counts)}) FROM {FACT_SQL}""",
)
def truncate_and_load(spark, sf):
    """The star loaded twice into one store; all rows of all tables as they are read back."""
    target = StarStore(spark, scratch_path(spark, "star"))
    load_star(build_star(wide_listings(spark, sf)), target)
    load_star({n: target.read(n) for n in LOAD_ORDER}, target)
    held = {
        "dim_host": ("host_key", ["host_id", "host_name", "host_verification", "calculated_host_listings_count"]),
        "dim_property_location": ("property_location_key", LOCATION_KEY),
        "dim_property": ("property_key", ["publication_key", *PROPERTY_COLUMNS]),
        "dim_date": ("date_key", ["full_date", "day_of_week", "month_name"]),
        "fact_publication": (
            "property_key",
            ["host_key", "property_location_key", "last_review_date_key", F.col("minimum_nights").cast("long"), *_counts],
        ),
    }
    result = None
    for name, (key, columns) in held.items():
        line = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
        part = target.read(name).select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("key"), line.alias("held"))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "star_constraints",
    """WITH parent AS (SELECT c_custkey AS host_key FROM customer WHERE c_custkey % 10 <> 0
        UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 100 = 1),
      child AS (SELECT o_orderkey AS fact_key, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS host_key FROM orders)
    SELECT * FROM (
      SELECT 'dim_host.host_key comes twice' AS "constraint", min(CAST(host_key AS VARCHAR)) AS example, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT host_key, count(*) AS n FROM parent GROUP BY 1 HAVING count(*) > 1) UNION ALL
      SELECT 'fact_publication.host_key has no member', min(CAST(host_key AS VARCHAR)), count(*) FROM child
        WHERE host_key NOT IN (SELECT host_key FROM parent) UNION ALL
      SELECT 'fact_publication.host_key is missing', NULL, count(*) FROM child WHERE host_key IS NULL) WHERE n > 0""",
)
def star_constraints(spark, sf):
    """Keys that are missing, given twice or without a member, in orders against some customers."""
    k = F.col("c_custkey")
    customers = table(spark, sf, "customer").select(k.alias("host_key"))
    parent = customers.where("host_key % 10 <> 0").unionByName(customers.where("host_key % 100 = 1"))
    child = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("fact_key"), null_every(7, "o_orderkey", F.col("o_custkey")).alias("host_key")
    )
    tables = {"dim_host": parent, "fact_publication": child}
    return broken_keys(
        tables, {"dim_host": "host_key", "fact_publication": "fact_key"}, [("fact_publication", "host_key", "dim_host")]
    )


@query(
    "fact_append",
    f"""SELECT publication_key, host_id, neighbourhood_group, neighbourhood, last_review, instant_bookable_flag, price,
      CAST(CAST(lat AS DECIMAL(10,7)) AS DOUBLE) AS lat, CAST(CAST(long AS DECIMAL(10,7)) AS DOUBLE) AS long FROM (SELECT * REPLACE (lower(instant_bookable_flag) = 'true' AS instant_bookable_flag) FROM {WIDE_SQL})""",
)
def fact_append(spark, sf):
    """A star of the earlier listings, two batches of later ones appended, one of them twice; through the natural keys."""
    wide = wide_listings(spark, sf)
    late = F.coalesce(F.col("last_review") >= 19980501, F.lit(False))
    store = StarStore(spark, scratch_path(spark, "star"))
    store.load(build_star(wide.where(~late)))
    for part in (0, 1, 1):
        store.append(wide.where(late & (F.col("publication_key") % 2 == part)), f"late-{part}")
    star = {n: store.read(n) for n in LOAD_ORDER}
    fact = star["fact_publication"]
    for name, key in (("dim_property", "property_key"), ("dim_host", "host_key"), ("dim_property_location", "property_location_key")):
        fact = fact.join(star[name], key)
    fact = fact.join(star["dim_date"].withColumnRenamed("date_key", "last_review_date_key"), "last_review_date_key")
    return fact.select(
        "publication_key",
        "host_id",
        F.col("listing_neighbourhood_group").alias("neighbourhood_group"),
        F.col("listing_neighbourhood").alias("neighbourhood"),
        F.col("listing_lat").cast("double").alias("lat"),
        F.col("listing_long").cast("double").alias("long"),
        F.col("last_review_date_key").alias("last_review"),
        "instant_bookable_flag",
        "price",
    )
