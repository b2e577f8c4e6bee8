"""Files, landed JSON, unions, incremental collection, table writes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.operators.dedupe import collect_new, enrich, union_all, work_list
from geomart.queries.base import PART_AT, coords, coords_sql, null_every, query, table
from geomart.session import materialize, scratch_path
from geomart.sources import files
from geomart.sources.seen import SeenIds
from geomart.sources.tables import FolderTables, first_rows, replace_append


@query(
    "csv_scan",
    """SELECT c_custkey, 'Café "' || c_name || '", Málaga' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def csv_scan(spark, sf):
    name = F.concat(F.lit('Café "'), F.col("c_name"), F.lit('", Málaga'))
    customer = table(spark, sf, "customer").withColumn("c_name", name)
    path = scratch_path(spark, "customers-csv")
    files.write_csv(customer, path, encoding="ISO-8859-1")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in customer.schema.fields])
    return files.read_csv(spark, path, schema).drop(files.CORRUPT)


_la, _lo = coords_sql(*PART_AT)


@query(
    "flatten_nested_json",
    f"""SELECT 'p' || p_partkey AS fsq_id, p_name AS name, {_la} AS latitude, {_lo} AS longitude,
      CASE WHEN p_size % 5 <> 0 THEN p_type END AS category_main_name,
      CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS BIGINT) ELSE -1 END AS category_main_id,
      CASE WHEN p_size % 5 <> 0 THEN '[{{"id":' || p_size || ',"name":"' || p_type || '"}},{{"id":0,"name":"any"}}]'
        ELSE '[]' END AS all_categories,
      p_name || ', ' || p_brand AS address, p_brand AS locality, 'NY' AS region, p_brand AS area_searched,
      p_size AS price_tier, p_retailprice AS rating, CASE WHEN p_size % 3 <> 0 THEN p_retailprice / 100 END AS popularity_score,
      CAST(p_size * 2 AS INTEGER) AS tips_count
    FROM part""",
)
def flatten(spark, sf):
    lat, lon = coords(*PART_AT)
    categories = F.when(
        F.col("p_size") % 5 != 0,
        F.array(
            F.struct(F.col("p_size").cast("long").alias("id"), F.col("p_type").alias("name")),
            F.struct(F.lit(0).cast("long").alias("id"), F.lit("any").alias("name")),
        ),
    ).otherwise(F.array().cast("array<struct<id:bigint,name:string>>"))
    place = F.struct(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("fsq_id"),
        F.col("p_name").alias("name"),
        F.struct(F.struct(lat.alias("latitude"), lon.alias("longitude")).alias("main")).alias("geocodes"),
        categories.alias("categories"),
        F.struct(
            F.concat_ws(", ", "p_name", "p_brand").alias("formatted_address"),
            F.col("p_brand").alias("locality"),
            F.lit("NY").alias("region"),
        ).alias("location"),
        F.col("p_size").alias("price"),
        F.col("p_retailprice").alias("rating"),
        null_every(3, "p_size", F.col("p_retailprice") / 100).alias("popularity"),
        F.struct((F.col("p_size") * 2).cast("int").alias("total_tips")).alias("stats"),
    )
    # Pages of at most 50 results: neighbouring keys of one brand.
    pages = (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("area"), F.floor(F.col("p_partkey") / 50).cast("int").alias("page"))
        .agg(F.collect_list(place).alias("results"))
    )
    path = scratch_path(spark, "pages")
    pages.write.json(path)
    flat = files.flatten_places(files.read_pages(spark, path))
    return flat.withColumn("category_main_id", F.coalesce("category_main_id", F.lit(-1)))


@query(
    "enrich_details",
    """SELECT o_orderkey, o_custkey, c_name, c_custkey IS NOT NULL AS found
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""",
)
def enrich_details(spark, sf):
    hits = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    landed = table(spark, sf, "customer").where("c_acctbal > 0")
    found, missing = enrich(hits, landed.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    return union_all(found.withColumn("found", F.lit(True)), missing.withColumn("found", F.lit(False)))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "work_list_cross",
    """SELECT c_custkey AS area, category FROM customer,
      (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS category)
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = category)""",
)
def work(spark, sf):
    areas = table(spark, sf, "customer").select(F.col("c_custkey").alias("area"))
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("area"), F.col("o_orderpriority").alias("category"))
    return work_list(areas, "area", PRIORITIES, done)


@query(
    "incremental_dedupe",
    """WITH e AS (SELECT event_id, ts, user_id || '-' || event_type || '-' || (props->>'k') AS pair FROM events)
    SELECT event_id, pair FROM e WHERE pair NOT IN (SELECT pair FROM e WHERE ts < TIMESTAMP '2024-01-16')
    QUALIFY row_number() OVER (PARTITION BY pair ORDER BY ts, event_id) = 1""",
)
def incremental(spark, sf):
    pair = F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.get_json_object("props", "$.k"))
    events = table(spark, sf, "events").select("event_id", "ts", pair.alias("pair"))
    seen = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return collect_new(events, seen, "pair", ["ts", "event_id"]).select("event_id", "pair")


@query(
    "incremental_bucketed",
    """WITH e AS (SELECT event_id, ts, user_id || '-' || event_type || '-' || (props->>'k') AS pair FROM events)
    SELECT event_id, pair, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS collected FROM e
    QUALIFY row_number() OVER (PARTITION BY pair ORDER BY CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END, ts, event_id) = 1""",
)
def incremental_bucketed(spark, sf):
    """Two batches of events, the second one overlapping the first, each against the ids seen before."""
    pair = F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.get_json_object("props", "$.k"))
    events = table(spark, sf, "events").select("event_id", "ts", pair.alias("pair"))
    base = scratch_path(spark, "seen")
    seen = SeenIds(spark, "seen_" + base.rsplit("-", 1)[-1], "pair", 16).create(events, f"{base}/ids")
    first = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    collected = None
    for number, batch in ((1, first), (2, events)):
        new = materialize(seen.fresh(batch, ["ts", "event_id"]), "collected")
        seen.add(new)
        part = new.select("event_id", "pair", F.lit(number).alias("collected"))
        collected = part if collected is None else collected.unionByName(part)
    spark.sql(f"DROP TABLE {seen.table}")  # the ids stay in their folder
    return collected


@query(
    "union_all_sources",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_sources(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    return union_all(customer, supplier)


@query(
    "table_scan_limit",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5",
)
def scan_limit(spark, sf):
    return first_rows(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 5).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("replace_append", "SELECT * FROM customer")
def replace(spark, sf):
    target = FolderTables(spark, scratch_path(spark, "tables"))
    customer = table(spark, sf, "customer")
    replace_append(customer, target, "customer")
    return replace_append(customer, target, "customer")
