"""Counts, summaries, shapes of distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomart.operators import profile as P
from geomart.operators.dedupe import duplicate_count
from geomart.operators.increments import ProfileStore
from geomart.queries.base import null_every, null_every_sql, query, table
from geomart.session import scratch_path


@query(
    "value_counts",
    "SELECT CAST(l_quantity AS DOUBLE) AS value, count(*) AS n FROM lineitem GROUP BY 1",
)
def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "lineitem"), "l_quantity").orderBy("value")


_ev = null_every_sql(7, "event_id", "event_type")


@query("value_counts_with_null", f"SELECT {_ev} AS value, count(*) AS n FROM events GROUP BY 1")
def value_counts_with_null(spark, sf):
    events = table(spark, sf, "events").select(null_every(7, "event_id", F.col("event_type")).alias("event_type"))
    return P.value_counts(events, "event_type", with_null=True)


@query(
    "top_n_values",
    "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 20",
)
def top_n(spark, sf):
    return P.top_n_values(table(spark, sf, "lineitem"), "l_partkey", 20)


@query("distinct_values", "SELECT DISTINCT p_name FROM part")
def distinct_values(spark, sf):
    return P.distinct_values(table(spark, sf, "part"), "p_name")


_part_columns = ("p_name", "p_brand", "p_type", "p_size")


@query(
    "distinct_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique,
        count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique_with_null
        FROM (SELECT {null_every_sql(9, "p_partkey", "p_name")} AS p_name, p_brand, p_type, p_size FROM part)"""
        for c in _part_columns
    ),
)
def distinct_profile(spark, sf):
    part = table(spark, sf, "part").withColumn("p_name", null_every(9, "p_partkey", F.col("p_name")))
    return P.distinct_profile(part, _part_columns)


@query(
    "duplicate_count",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicate_rows FROM documents",
)
def duplicates(spark, sf):
    return duplicate_count(table(spark, sf, "documents").select("text", "lang"))


def _holed(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        null_every(7, "c_custkey", F.col("c_name")).alias("c_name"),
        null_every(5, "c_custkey", F.col("c_acctbal")).alias("c_acctbal"),
        null_every(3, "c_custkey", F.col("c_mktsegment")).alias("c_mktsegment"),
    )


_holed_sql = f"""(SELECT c_custkey, {null_every_sql(7, "c_custkey", "c_name")} AS c_name,
  {null_every_sql(5, "c_custkey", "c_acctbal")} AS c_acctbal,
  {null_every_sql(3, "c_custkey", "c_mktsegment")} AS c_mktsegment FROM customer)"""


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
        round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_percent FROM {_holed_sql}"""
        for c in ("c_name", "c_acctbal", "c_mktsegment")
    ),
)
def null_profile(spark, sf):
    return P.null_profile(_holed(spark, sf)).withColumn("null_percent", F.round("null_percent", 6))


@query(
    "table_info",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS column_type,
        count(*) AS row_count, count({c}) AS non_null_count FROM {_holed_sql}"""
        for i, (c, t) in enumerate(
            (("c_custkey", "bigint"), ("c_name", "string"), ("c_acctbal", "double"), ("c_mktsegment", "string"))
        )
    ),
)
def table_info(spark, sf):
    return P.table_info(_holed(spark, sf))


_numeric = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem"""
        for c in _numeric
    ),
)
def describe_numeric(spark, sf):
    return _rounded(
        P.describe_numeric(table(spark, sf, "lineitem"), _numeric), "mean", "std", "min", "q25", "q50", "q75", "max"
    )


_by_type = ("c_custkey", "c_nationkey", "c_acctbal")


@query(
    "describe_by_type",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c}), 4)::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4)::DOUBLE AS max FROM customer"""
        for c in _by_type
    ),
)
def describe_by_type(spark, sf):
    """The numeric columns are found by their type."""
    return _rounded(P.describe_numeric(table(spark, sf, "customer")), "mean", "std", "min", "q25", "q50", "q75", "max")


_text = ("c_name", "c_mktsegment")


@query(
    "describe_categorical",
    " UNION ALL ".join(
        f"""(SELECT '{c}' AS column_name, CAST(sum(k) OVER () AS BIGINT) AS n, count(*) OVER () AS n_unique,
        v AS top, k AS freq
        FROM (SELECT {c} AS v, count(*) AS k FROM {_holed_sql} WHERE {c} IS NOT NULL GROUP BY 1)
        ORDER BY k DESC, v LIMIT 1)"""
        for c in _text
    ),
)
def describe_categorical(spark, sf):
    return P.describe_categorical(_holed(spark, sf), _text)


def _as_text(*columns):
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns}


def _event_times_sql(c):
    micro = f"epoch_us({c})"
    text = lambda e: f"strftime(make_timestamp(CAST(floor({e}) AS BIGINT)), '%Y-%m-%d %H:%M:%S')"
    return f"""count({c}) AS n, {text(f"avg({micro})")} AS mean, {text(f"min({micro})")} AS min,
      {text(f"quantile_cont(CAST({micro} AS DOUBLE), 0.25)")} AS q25,
      {text(f"quantile_cont(CAST({micro} AS DOUBLE), 0.5)")} AS q50,
      {text(f"quantile_cont(CAST({micro} AS DOUBLE), 0.75)")} AS q75, {text(f"max({micro})")} AS max"""


@query(
    "describe_datetime",
    f"""SELECT 'o_orderdate' AS column_name, {_event_times_sql("o_orderdate")} FROM orders""",
)
def describe_datetime(spark, sf):
    return P.describe_datetime(table(spark, sf, "orders"), ["o_orderdate"]).withColumns(
        _as_text("mean", "min", "q25", "q50", "q75", "max")
    )


@query(
    "most_active_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1
    ORDER BY n DESC, year LIMIT 1""",
)
def most_active_year(spark, sf):
    return P.most_active_year(table(spark, sf, "orders"), "o_orderdate")


def _skewed(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        v.alias("plain"),
        F.pow(v + 1, F.lit(4.0)).alias("strong"),
        F.floor(F.pow(v / 50, F.lit(6.0))).alias("zeros"),
        (F.pow(v, F.lit(4.0)) - 1000).alias("negative"),
    )


_skewed_sql = """(SELECT value AS plain, pow(value + 1, 4.0) AS strong, floor(pow(value / 50, 6.0)) AS zeros,
  pow(value, 4.0) - 1000 AS negative FROM events)"""


@query(
    "skewness_log_rule",
    " UNION ALL ".join(
        f"""SELECT column_name, round(s, 4) AS skewness, below, zeros, CASE WHEN abs(s) <= 2 THEN 'none'
          WHEN below > 0 OR zeros = n THEN 'not possible' WHEN zeros > 0 THEN 'log1p' ELSE 'log' END AS transform
        FROM (SELECT '{c}' AS column_name, skewness({c}) AS s, count(*) AS n, count(*) FILTER ({c} < 0) AS below,
          count(*) FILTER ({c} = 0) AS zeros FROM {_skewed_sql})"""
        for c in ("plain", "strong", "zeros", "negative")
    ),
)
def skewness(spark, sf):
    return _rounded(P.skewness_log_rule(_skewed(spark, sf), ["plain", "strong", "zeros", "negative"]), "skewness")


@query(
    "histogram",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
      c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
        FROM events, s GROUP BY 1)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 50 * b.bin, 4) AS low,
      round(lo + (hi - lo) / 50 * (b.bin + 1), 4) AS high, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(50)) AS bin) b, s LEFT JOIN c ON c.bin = b.bin""",
)
def histogram(spark, sf):
    return _rounded(P.histogram(table(spark, sf, "events"), "value", 50), "low", "high")


@query(
    "boxplot_stats",
    " UNION ALL ".join(
        f"""SELECT column_name, q25, q50, q75,
          round(least(min(v) FILTER (v >= q25 - 1.5 * (q75 - q25) AND v <= q75 + 1.5 * (q75 - q25)), q25), 4) AS whisker_low,
          round(greatest(max(v) FILTER (v >= q25 - 1.5 * (q75 - q25) AND v <= q75 + 1.5 * (q75 - q25)), q75), 4) AS whisker_high,
          count(*) FILTER (v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outliers
        FROM (SELECT {c} AS v FROM {t}), (SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q25,
          quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 FROM {t}) GROUP BY 1, 2, 3, 4"""
        for c, t in (("l_quantity", "lineitem"), ("l_extendedprice", "lineitem"))
    ),
)
def boxplot(spark, sf):
    return _rounded(
        P.boxplot_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), "whisker_low", "whisker_high"
    )


@query(
    "kde_curve",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS total,
        stddev_samp(value) * pow(count(*), -0.2) AS w FROM events),
      g AS (SELECT p AS point, lo + (hi - lo) / 199 * p AS x, w, total FROM s, (SELECT unnest(range(200)) AS p))
    SELECT CAST(point AS INTEGER) AS point, round(x, 4) AS x,
      round(sum(exp(-0.5 * pow((x - value) / w, 2)) / (sqrt(2.0 * pi()) * w)) / total, 6) AS density
    FROM g, events WHERE value IS NOT NULL GROUP BY point, x, total""",
)
def kde(spark, sf):
    curve = P.kde_curve(table(spark, sf, "events"), "value")
    return curve.select("point", F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


_batched = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@query(
    "profile_incremental",
    f"""WITH l AS (SELECT * REPLACE ({null_every_sql(7, "l_orderkey", "l_discount")} AS l_discount) FROM lineitem) """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_count, round(avg({c}), 6) AS mean,
      round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS most FROM l"""
        for c in _batched
    ),
)
def profile_incremental(spark, sf):
    """Three batches of line items, one of them added twice, profiled from their kept rows; the exact figures."""
    lines = table(spark, sf, "lineitem").withColumn("l_discount", null_every(7, "l_orderkey", F.col("l_discount")))
    store = ProfileStore(spark, scratch_path(spark, "profile"))
    for part in (0, 1, 2, 1):
        store.add(f"part-{part}", lines.where(F.col("l_orderkey") % 3 == part), _batched)
    rounded = {c: F.round(c, 6) for c in ("mean", "std")}
    return store.profile().withColumns(rounded).select("column_name", "rows", "null_count", "mean", "std", "least", "most")
