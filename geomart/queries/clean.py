"""Typing, filters, text, fills, mapping, fuzzy matching, dense keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomart.functions import dates as D
from geomart.functions import text as X
from geomart.operators import columns as C
from geomart.operators.keys import category_encode, dense_key
from geomart.operators.mapping import category_map, changed_count, fuzzy_standardize
from geomart.operators.matching import match_by_table
from geomart.operators.profile import impute_median_mode
from geomart.plans.cleaning import clean_listings, clean_places
from geomart.queries.base import SUPPLIER_AT, coords, coords_sql, null_every, null_every_sql, query, table
from geomart.session import scratch_path
from geomart.sources import files


@query(
    "normalize_columns",
    """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_, p_size AS size_cm
    FROM part""",
)
def normalize(spark, sf):
    messy = table(spark, sf, "part").select(
        F.col("p_partkey").alias("Part KEY"),
        F.col("p_name").alias("Part Name"),
        F.col("p_brand").alias("Brand (%)"),
        F.col("p_size").alias("SIZE CM!"),
    )
    return C.normalize_columns(messy)


@query("require_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def require(spark, sf):
    return C.require_columns(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])


@query(
    "dense_key",
    """SELECT o_orderkey, CAST(149999 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS host_id
    FROM orders""",
)
def dense(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dense_key(orders, "host_id", ["o_orderdate", "o_orderkey"], start=150000).drop("o_orderdate")


@query(
    "category_encode",
    """SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS type_code FROM part""",
)
def encode(spark, sf):
    return category_encode(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "type_code", 50)


_seg = null_every_sql(7, "c_custkey", "c_mktsegment")


def _segments(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", null_every(7, "c_custkey", F.col("c_mktsegment")).alias("segment")
    )


@query(
    "filter_in",
    f"SELECT * FROM (SELECT c_custkey, {_seg} AS segment FROM customer) WHERE segment IN ('BUILDING', 'MACHINERY')",
)
def filter_in(spark, sf):
    return C.keep_in(_segments(spark, sf), "segment", ["BUILDING", "MACHINERY"])


@query(
    "filter_not_in_keep_null",
    f"""SELECT * FROM (SELECT c_custkey, {_seg} AS segment FROM customer)
    WHERE segment IS NULL OR segment NOT IN ('BUILDING', 'MACHINERY')""",
)
def filter_not_in(spark, sf):
    return C.keep_not_in(_segments(spark, sf), "segment", ["BUILDING", "MACHINERY"])


def _holed_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        null_every(5, "o_orderkey", F.col("o_orderpriority")).alias("priority"),
        null_every(7, "o_orderkey", F.col("o_totalprice")).alias("price"),
        null_every(3, "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.lit(3)).alias("reviews"),
    )


_holed = f"""SELECT o_orderkey, {null_every_sql(5, "o_orderkey", "o_orderpriority")} AS priority,
  {null_every_sql(7, "o_orderkey", "o_totalprice")} AS price,
  {null_every_sql(3, "o_orderkey", "strftime(o_orderdate, '%Y-%m-%d')")} AS day,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 3 END AS reviews FROM orders"""


@query("drop_nulls", f"SELECT * FROM ({_holed}) WHERE priority IS NOT NULL AND price IS NOT NULL")
def drop_nulls(spark, sf):
    return C.drop_nulls(_holed_orders(spark, sf), ["priority", "price"])


@query("conditional_drop", f"SELECT * FROM ({_holed}) WHERE NOT (reviews = 0 AND day IS NULL AND priority IS NULL)")
def conditional_drop(spark, sf):
    silent = (F.col("reviews") == 0) & F.col("day").isNull() & F.col("priority").isNull()
    return C.drop_where(_holed_orders(spark, sf), silent)


@query(
    "clean_text",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1, 2) THEN NULL ELSE p_name END AS name FROM part""",
)
def clean_text(spark, sf):
    rest = F.col("p_partkey") % 5
    raw = (
        F.when(rest == 0, F.lit(" nan "))
        .when(rest == 1, F.lit(" \t"))
        .when(rest == 2, F.lit("None"))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit("\n")))
    )
    return table(spark, sf, "part").select("p_partkey", X.clean_text(raw).alias("name"))


_KEPT = "[^a-zA-Z0-9 \\t\\n\\r\\x{0b}\\x{0c}\\x{85}\\x{a0}\\x{2002}\\x{2003}\\x{2009}\\x{3000}]"


@query(
    "regex_clean",
    f"""SELECT doc_id, length(t) AS n_chars, md5(t) AS digest
    FROM (SELECT doc_id, regexp_replace(text, '{_KEPT}', '', 'g') AS t FROM documents)""",
)
def regex_clean(spark, sf):
    t = X.keep_letters_digits(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.length(t).cast("long").alias("n_chars"), F.md5(t).alias("digest")
    )


@query(
    "text_parts",
    """SELECT doc_id, md5(replace(text, ', ', '')) AS without_commas, md5(split_part(text, ',', 1)) AS first_part,
      md5(array_to_string(string_split(text, ' '), ', ')) AS joined FROM documents""",
)
def text_parts(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(X.drop_comma_space(text)).alias("without_commas"),
        F.md5(X.first_part(text)).alias("first_part"),
        F.md5(X.join_parts(F.split(text, " "))).alias("joined"),
    )


@query(
    "safe_numeric",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE value END AS number FROM events""",
)
def safe_numeric(spark, sf):
    raw = (
        F.when(F.col("event_id") % 11 == 0, F.lit("n/a"))
        .when(F.col("event_id") % 13 == 0, F.lit("nan"))
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
    )
    return table(spark, sf, "events").select("event_id", X.to_number(raw).alias("number"))


@query(
    "safe_integer",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey ELSE -1 END AS whole, o_totalprice AS mixed FROM orders""",
)
def safe_integer(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("none"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .alias("whole"),
        F.col("o_totalprice").cast("string").alias("mixed"),
    )
    parsed = C.parse_integers(orders, ["whole", "mixed"])
    return parsed.withColumn("whole", F.coalesce("whole", F.lit(-1)))


@query(
    "safe_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def safe_date(spark, sf):
    raw = F.when(F.col("o_orderkey") % 6 == 0, F.lit("13/45/2020")).otherwise(
        F.date_format("o_orderdate", "M/d/yyyy")
    )
    day = F.date_format(D.parse_date(raw), "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"))


@query("parse_currency", "SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders")
def currency(spark, sf):
    raw = F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" "))
    return table(spark, sf, "orders").select("o_orderkey", X.parse_currency(raw).alias("price"))


@query(
    "map_boolean",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS is_verified,
      CASE o_orderstatus WHEN 'F' THEN 'false' WHEN 'O' THEN 'true' END AS is_unconfirmed,
      CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS bookable,
      o_orderstatus = 'F' AS is_true FROM orders""",
)
def map_boolean(spark, sf):
    flag = F.when(F.col("o_orderstatus") == "F", "verified").when(F.col("o_orderstatus") == "O", "unconfirmed")
    text = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "fALSE")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.flag_from_map(flag, {"verified": True, "unconfirmed": False}).cast("string").alias("is_verified"),
        X.flag_from_map(flag, {"verified": False, "unconfirmed": True}).cast("string").alias("is_unconfirmed"),
        X.flag_from_text(text).cast("string").alias("bookable"),
        X.is_true_text(text).alias("is_true"),
    )


TYPE_GROUPS = {
    "cultural": ["SMALL", "PROMO"],
    "restaurants": ["PROMO", "LARGE"],
    "landmarks": ["LARGE", "ECONOMY"],
}


@query(
    "category_map",
    """SELECT p_partkey, p_type, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'cultural'
      WHEN p_type = 'LARGE' THEN 'restaurants' WHEN p_type = 'ECONOMY' THEN 'landmarks'
      ELSE 'Other' END AS category_group FROM part""",
)
def map_categories(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    return category_map(parts, "p_type", "category_group", TYPE_GROUPS)


_pa, _po = coords_sql(*SUPPLIER_AT)


@query(
    "places_clean",
    f"""WITH raw AS (SELECT s_suppkey, {_pa} AS latitude, {_po} AS longitude,
        CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN n_name IN ('NATION_3', 'NATION_7') THEN 'NJ' ELSE n_name END AS region,
        CASE s_suppkey % 4 WHEN 0 THEN 'Museum' WHEN 1 THEN 'Wine Store' WHEN 2 THEN 'Comedy Club' ELSE 'Bank' END AS cat
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT row_number() OVER (ORDER BY s_suppkey) AS fsq_id, latitude, longitude,
      CASE cat WHEN 'Museum' THEN 'cultural' WHEN 'Wine Store' THEN 'restaurants'
        WHEN 'Comedy Club' THEN 'entertainment_&_leisure' ELSE 'Other' END AS category_group
    FROM raw WHERE region IS NULL OR region NOT IN ('NJ', 'CT', 'PA')""",
)
def places_clean(spark, sf):
    lat, lon = coords(*SUPPLIER_AT)
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    rest = F.col("s_suppkey") % 4
    raw = (
        table(spark, sf, "supplier")
        .join(nation, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("fsq_id"),
            F.col("s_name").alias("name"),
            lat.alias("latitude"),
            lon.alias("longitude"),
            F.when(F.col("s_suppkey") % 10 == 0, F.lit(None))
            .when(F.col("n_name").isin("NATION_3", "NATION_7"), "NJ")
            .otherwise(F.col("n_name"))
            .alias("region"),
            F.when(rest == 0, "Museum")
            .when(rest == 1, "Wine Store")
            .when(rest == 2, "Comedy Club")
            .otherwise("Bank")
            .alias("category_main_name"),
        )
    )
    groups = {
        "cultural": ["Museum"],
        "restaurants": ["Wine Store"],
        "entertainment_&_leisure": ["Comedy Club"],
        "bars_&_clubs": ["Wine Store", "Comedy Club"],
    }
    return clean_places(raw, groups)


_bal = null_every_sql(7, "c_custkey", "c_acctbal")
_seg9 = null_every_sql(9, "c_custkey", "c_mktsegment")


def _holed_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        null_every(7, "c_custkey", F.col("c_acctbal")).alias("balance"),
        null_every(9, "c_custkey", F.col("c_mktsegment")).alias("segment"),
    )


@query(
    "fill_constants",
    f"""SELECT c_custkey, coalesce({_bal}, 624.0) AS balance, coalesce({_seg9}, 'moderate') AS segment FROM customer""",
)
def fill_constants(spark, sf):
    return C.fill_constants(_holed_customers(spark, sf), {"balance": 624.0, "segment": "moderate", "absent": 1})


@query(
    "impute_median_mode",
    f"""WITH h AS (SELECT c_custkey, {_bal} AS balance, {_seg9} AS segment FROM customer),
      top AS (SELECT segment FROM h WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT c_custkey, round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM h)), 4) AS balance,
      coalesce(segment, (SELECT segment FROM top)) AS segment FROM h""",
)
def impute(spark, sf):
    filled = impute_median_mode(_holed_customers(spark, sf), ["balance"], ["segment"])
    return filled.withColumn("balance", F.round("balance", 4))


def _holed_day():
    return null_every(4, "o_orderkey", F.col("o_orderdate"))


@query(
    "sentinel_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '2262-04-11' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders""",
)
def sentinel(spark, sf):
    day = F.date_format(D.fill_sentinel(_holed_day()), "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"))


@query(
    "date_key",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) ELSE 0 END AS day_key
    FROM orders""",
)
def date_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(D.date_key(_holed_day()), F.lit(0)).alias("day_key"))


@query(
    "coercion_report",
    """WITH r AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'n/a' ELSE 'ok' END AS v
      FROM events)
    SELECT 'raw' AS column_name, count(*) FILTER (v IS NULL) AS nulls_before,
      count(*) FILTER (v IS NULL OR v = 'n/a') AS nulls_after, count(*) FILTER (v = 'n/a') AS coerced FROM r""",
)
def coercion(spark, sf):
    raw = F.when(F.col("event_id") % 17 == 0, F.lit(None)).when(F.col("event_id") % 11 == 0, F.lit("n/a")).otherwise(
        F.col("value").cast("string")
    )
    events = table(spark, sf, "events").select(raw.alias("raw"))
    return C.coercion_report(events, {"raw": X.to_number(F.col("raw"))})


SEGMENTS = ("MACHINERY", "FURNITURE", "BUILDING", "AUTOMOBILE", "HOUSEHOLD")


def _misspelled(spark, sf):
    seg = F.col("c_mktsegment")
    cut = F.concat(F.substring(seg, 1, 2), F.substring(seg, 4, 100))
    odd = (
        F.when(F.col("c_custkey") % 13 == 0, F.lit(None))
        .when(F.col("c_custkey") % 11 == 0, F.lit("GARDEN"))
        .when(F.col("c_custkey") % 4 == 0, cut)
        .otherwise(seg)
    )
    return table(spark, sf, "customer").select("c_custkey", odd.alias("segment"))


_misspelled_sql = """SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'GARDEN'
  WHEN c_custkey % 4 = 0 THEN substring(c_mktsegment, 1, 2) || substring(c_mktsegment, 4) ELSE c_mktsegment END AS segment
  FROM customer"""
_choices_sql = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SEGMENTS))


def _fuzzy_sql(cutoff: float | None) -> str:
    keep = f"WHERE score >= {cutoff}" if cutoff is not None else ""
    return f"""WITH m AS ({_misspelled_sql}), c(pos, choice) AS (VALUES {_choices_sql}),
      s AS (SELECT DISTINCT segment, pos, choice, 100.0::DOUBLE * (1 - levenshtein(segment, choice)::DOUBLE
          / greatest(length(segment), length(choice))) AS score FROM m, c WHERE segment IS NOT NULL),
      best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY segment ORDER BY score DESC, pos) = 1)
    SELECT c_custkey, m.segment, coalesce(b.choice, m.segment) AS standard
    FROM m LEFT JOIN (SELECT * FROM best {keep}) b ON b.segment = m.segment"""


@query("fuzzy_standardize", _fuzzy_sql(80))
def fuzzy_cut(spark, sf):
    return fuzzy_standardize(_misspelled(spark, sf), "segment", SEGMENTS, 80, "levenshtein", "standard")


@query("fuzzy_best_match", _fuzzy_sql(None))
def fuzzy_best(spark, sf):
    return fuzzy_standardize(_misspelled(spark, sf), "segment", SEGMENTS, None, "levenshtein", "standard")


@query(
    "fuzzy_weighted",
    f"""SELECT c_custkey, segment, CASE WHEN segment = 'GARDEN' OR segment IS NULL THEN segment
      ELSE (SELECT c_mktsegment FROM customer k WHERE k.c_custkey = m.c_custkey) END AS standard FROM ({_misspelled_sql}) m""",
)
def fuzzy_weighted(spark, sf):
    return fuzzy_standardize(_misspelled(spark, sf), "segment", SEGMENTS, 85, "weighted", "standard")


@query(
    "fuzzy_changed_count",
    f"SELECT count(*) FILTER (segment IS DISTINCT FROM standard) AS changed FROM ({_fuzzy_sql(80)})",
)
def fuzzy_changed(spark, sf):
    done = fuzzy_standardize(_misspelled(spark, sf), "segment", SEGMENTS, 80, "levenshtein", "standard")
    return changed_count(done, "segment", "standard")


def raw_listings(spark, sf):
    """Orders as untyped listings, every column text and dirty in its own way."""
    k = F.col("o_orderkey")
    lat, lon = coords("o_orderkey", 37, 91)
    boroughs = F.array(*[F.lit(b) for b in ("Manhattan", "brookln", "Queens", "Bronx", "Staten Island")])
    rooms = F.array(*[F.lit(r) for r in ("Private room", "Entire home/apt", "Shared room", "Hotel room")])
    at = lambda options, n: F.element_at(options, (k % n + 1).cast("int"))
    return table(spark, sf, "orders").select(
        k.cast("string").alias("id"),
        F.when(k % 9 != 0, F.concat(F.lit(" "), F.col("o_orderpriority"))).otherwise("nan").alias("NAME"),
        F.col("o_custkey").cast("string").alias("host id"),
        F.when(k % 2 == 0, "verified").when(k % 3 == 0, "unconfirmed").alias("host_identity_verified"),
        F.concat(F.lit("Host "), F.col("o_custkey").cast("string")).alias("host name"),
        F.when(k % 50 != 0, at(boroughs, 5)).alias("neighbourhood group"),
        F.col("o_orderstatus").alias("neighbourhood"),
        lat.cast("string").alias("lat"),
        lon.cast("string").alias("long"),
        F.lit("United States").alias("country"),
        F.lit("US").alias("country code"),
        F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "False").alias("instant_bookable"),
        F.when(k % 8 != 0, "strict").alias("cancellation_policy"),
        at(rooms, 4).alias("room type"),
        F.when(k % 10 != 0, (k % 20 + 2003).cast("string")).alias("Construction year"),
        F.when(k % 12 != 0, F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" "))).alias("price"),
        F.when(k % 12 != 1, F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("service fee"),
        F.when(k % 11 != 0, (k % 30).cast("string")).alias("minimum nights"),
        F.when(k % 6 != 0, (k % 40).cast("string")).alias("number of reviews"),
        F.when(k % 6 != 0, F.date_format("o_orderdate", "M/d/yyyy")).alias("last review"),
        F.when(k % 6 != 0, (k % 7 / F.lit(2.0)).cast("string")).alias("reviews per month"),
        F.when(k % 18 != 0, (k % 5 + 1).cast("string")).alias("review rate number"),
        F.when(k % 14 != 0, (k % 9).cast("string")).alias("calculated host listings count"),
        F.when(k % 15 != 0, (k % 366).cast("string")).alias("availability 365"),
        F.lit(None).cast("string").alias("license"),
        F.lit("no parties").alias("house_rules"),
    )


_l, _o = coords_sql("o_orderkey", 37, 91)


@query(
    "listings_clean",
    f"""SELECT o_orderkey AS id, o_custkey AS host_id,
      CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority ELSE 'no_name' END AS name,
      'Host ' || o_custkey AS host_name,
      CASE o_orderkey % 5 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Queens' WHEN 3 THEN 'Bronx'
        ELSE 'Staten Island' END AS neighbourhood_group,
      o_orderstatus AS neighbourhood, {_l} AS lat, {_o} AS long,
      CASE WHEN o_orderkey % 8 <> 0 THEN 'strict' ELSE 'moderate' END AS cancellation_policy,
      CASE o_orderkey % 4 WHEN 0 THEN 'Private room' WHEN 1 THEN 'Entire home/apt' WHEN 2 THEN 'Shared room'
        ELSE 'Hotel room' END AS room_type,
      CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 20 + 2003 ELSE 2012 END AS construction_year,
      CASE WHEN o_orderkey % 12 <> 0 THEN round(o_totalprice, 2) ELSE 624.0 END AS price,
      CASE WHEN o_orderkey % 12 <> 1 THEN round(o_totalprice, 2) ELSE 125.0 END AS service_fee,
      CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 30 ELSE 3 END AS minimum_nights,
      CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 40 ELSE 0 END AS number_of_reviews,
      CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2262-04-11' END AS last_review,
      CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 7) / 2.0::DOUBLE ELSE 0.0 END AS reviews_per_month,
      o_orderkey % 5 + 1 AS review_rate_number,
      CASE WHEN o_orderkey % 14 <> 0 THEN o_orderkey % 9 ELSE 1 END AS calculated_host_listings_count,
      CASE WHEN o_orderkey % 15 <> 0 THEN o_orderkey % 366 ELSE 96 END AS availability_365,
      o_orderkey % 2 = 0 AS host_verification, o_orderkey % 3 = 0 AS instant_bookable_flag
    FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 18 <> 0""",
)
def listings_clean(spark, sf):
    landed = scratch_path(spark, "listings-csv")
    raw = raw_listings(spark, sf)
    files.write_csv(raw, landed, encoding="ISO-8859-1")
    clean = clean_listings(files.read_csv(spark, landed, raw.schema).drop(files.CORRUPT))
    return clean.withColumn("last_review", F.date_format("last_review", "yyyy-MM-dd"))


_words = "SELECT DISTINCT w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM {}) WHERE regexp_matches(w, '^[!-~]+$')"


@query(
    "fuzzy_blocked",
    f"""WITH v AS ({_words.format("conversations")}), c AS ({_words.format("benchmark")}),
      s AS (SELECT v.w, c.w AS choice, 100.0 * (1 - levenshtein(v.w, c.w) / greatest(length(v.w), length(c.w))::DOUBLE) AS score
        FROM v, c WHERE least(length(v.w), length(c.w)) >= 0.8 * greatest(length(v.w), length(c.w)) - 1e-9),
      b AS (SELECT w, choice FROM s WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY w ORDER BY score DESC, choice) = 1)
    SELECT v.w AS word, coalesce(b.choice, v.w) AS standard FROM v LEFT JOIN b ON b.w = v.w""",
)
def fuzzy_blocked(spark, sf):
    """Words of the conversations, each by the word of the benchmark that comes nearest."""

    def words(name):
        every = table(spark, sf, name).select(F.explode(F.split("text", " ")).alias("word"))
        return every.where(F.col("word").rlike("^[!-~]+$")).distinct()

    return match_by_table(words("conversations"), "word", dense_key(words("benchmark"), "place", ["word"]), "word", "place", 80, out="standard")
