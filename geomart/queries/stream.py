"""Messages: publish, consume, shape, dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.operators.quality import BETWEEN, IN_SET, NOT_NULL, Expectation, Suite
from geomart.queries.base import null_every, null_every_sql, query, table
from geomart.session import scratch_path
from geomart.streaming import consume as S
from geomart.streaming import log as L
from geomart.streaming.batches import close_batches, deliver_batches, finish
from geomart.streaming.records import publish_folder, to_records


@query("json_extract", "SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events")
def json_extract(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").select("event_id", k.alias("k"))


def _events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", null_every(7, "event_id", F.col("event_type")).alias("event_type"), "value"
    )


_type = null_every_sql(7, "event_id", "event_type")


@query(
    "kafka_records",
    f"""SELECT CAST(event_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS event_id,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, {_type} AS event_type, value, {_type} IS NULL AS null_kept FROM events""",
)
def kafka_records(spark, sf):
    value = F.col("value")
    return to_records(_events(spark, sf), "event_id").select(
        "key",
        F.get_json_object(value, "$.event_id").alias("event_id"),
        F.get_json_object(value, "$.ts").alias("ts"),
        F.get_json_object(value, "$.event_type").alias("event_type"),
        F.get_json_object(value, "$.value").cast("double").alias("value"),
        value.contains('"event_type":null').alias("null_kept"),
    )


LISTING = (
    T.StructType()
    .add("publication_key", "long")
    .add("price", "double")
    .add("last_review", "string")
    .add("host_verification", "string")
    .add("instant_bookable_flag", "string")
)


def _listings(spark, sf, extra=None):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("publication_key"),
        F.col("o_totalprice").alias("price"),
        F.when(k % 5 == 0, F.lit(None))
        .when(k % 7 == 0, F.lit(22620411))
        .when(k % 11 == 0, F.lit(20201399))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
        .alias("last_review"),
        F.when(k % 3 != 0, k % 3 == 1).alias("host_verification"),
        F.when(k % 4 == 0, "TRUE").when(k % 4 == 1, "no").alias("instant_bookable_flag"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


@query(
    "stream_shape",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS publication_key, o_totalprice AS price,
      CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL
        ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS last_review_date,
      CASE o_orderkey % 3 WHEN 1 THEN 'true' WHEN 2 THEN 'false' END AS host_verification,
      CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS instant_bookable_flag,
      CASE WHEN o_orderkey % 6 = 0 THEN '{"note":null,"extra":"[' || o_orderkey || ']"}'
        ELSE '{"note":"' || o_orderstatus || '","extra":"[' || o_orderkey || ']"}' END AS rest
    FROM orders""",
)
def stream_shape(spark, sf):
    k = F.col("o_orderkey")
    extra = {"note": F.when(k % 6 != 0, F.col("o_orderstatus")), "extra": F.array(k)}
    records = to_records(_listings(spark, sf, extra), "publication_key")
    shaped = S.shape(S.decode(records, LISTING), LISTING, names={"last_review": "last_review_date"})
    shaped = shaped.withColumn("rest", F.to_json("rest", {"ignoreNullFields": "false"}))
    return shaped.withColumns({c: F.col(c).cast("string") for c in ("host_verification", "instant_bookable_flag")})


EVENT = (
    T.StructType()
    .add("event_id", "long")
    .add("ts", "string")
    .add("user_id", "long")
    .add("event_type", "string")
    .add("value", "double")
)


@query(
    "stream_consume",
    f"""SELECT CAST(event_id AS VARCHAR) AS key, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, user_id,
      {_type} AS event_type, value FROM events""",
)
def stream_consume(spark, sf):
    base = scratch_path(spark, "stream")
    publish_folder(_events(spark, sf), f"{base}/topic", "event_id")
    run = S.consume(S.read_folder(spark, f"{base}/topic"), EVENT, f"{base}/out", f"{base}/dead", f"{base}/position")
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id", "part", "chunk", "rest", "record_position")


_text = """(SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'not json' WHEN event_id % 10 = 1 THEN '[' || event_id || ']'
  WHEN event_id % 10 = 2 THEN '{ }' ELSE '{"event_id":' || event_id || '}' END AS value FROM events)"""


@query(
    "stream_dead_letter",
    f"""SELECT CAST(event_id AS VARCHAR) AS key, CASE WHEN event_id % 10 < 3 THEN value END AS value,
      CASE WHEN event_id % 10 >= 3 THEN event_id ELSE -1 END AS event_id FROM {_text}""",
)
def stream_dead_letter(spark, sf):
    k = F.col("event_id")
    text = (
        F.when(k % 10 == 0, F.lit("not json"))
        .when(k % 10 == 1, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
        .when(k % 10 == 2, F.lit("{ }"))
        .otherwise(F.concat(F.lit('{"event_id":'), k.cast("string"), F.lit("}")))
    )
    base = scratch_path(spark, "letters")
    records = table(spark, sf, "events").select(k.cast("string").alias("key"), text.alias("value"))
    records.write.parquet(f"{base}/topic")
    schema = T.StructType().add("event_id", "long")
    run = S.consume(S.read_folder(spark, f"{base}/topic"), schema, f"{base}/out", f"{base}/dead", f"{base}/position")
    run.awaitTermination()
    dead = spark.read.parquet(f"{base}/dead").select("key", "value")
    good = spark.read.parquet(f"{base}/out").select("key", "event_id")
    both = dead.unionByName(good, allowMissingColumns=True)
    return both.withColumn("event_id", F.coalesce("event_id", F.lit(-1)))


CHECKS = Suite(
    "events",
    (
        Expectation(NOT_NULL, "event_type"),
        Expectation(IN_SET, "event_type", value_set=("click", "view", "purchase")),
        Expectation(BETWEEN, "value", 20, 90),
    ),
)
_failed = f"""list_filter([CASE WHEN t IS NULL THEN '{CHECKS.expectations[0].label}' END,
  CASE WHEN t NOT IN ('click', 'view', 'purchase') THEN '{CHECKS.expectations[1].label}' END,
  CASE WHEN value < 20 OR value > 90 THEN '{CHECKS.expectations[2].label}' END], lambda x: x IS NOT NULL)"""
_checked = f"""(SELECT event_id, event_id % 13 = 0 AS lost, {_failed} AS failed FROM (SELECT event_id, value, {_type} AS t FROM events))"""


def _checked_events(spark, sf, name):
    """The events, some of them unreadable, through a log topic and the suite; the folders written."""
    base = scratch_path(spark, name)
    records = to_records(_events(spark, sf), "event_id").withColumns(
        {"value": F.when(F.col("key").cast("long") % 13 == 0, F.substring("value", 2, 9)).otherwise(F.col("value"))}
    )
    records.write.parquet(f"{base}/topic")
    folders = {n: f"{base}/{n}" for n in ("out", "dead", "quarantine", "counters")}
    run = S.consume(
        S.read_folder(spark, f"{base}/topic", max_files=2),
        EVENT,
        folders["out"],
        folders["dead"],
        f"{base}/position",
        suite=CHECKS,
        quarantine=folders["quarantine"],
        counters=folders["counters"],
    )
    run.awaitTermination()
    return folders


@query(
    "stream_quality",
    f"""SELECT event_id, CASE WHEN lost THEN 'dead' WHEN len(failed) > 0 THEN 'quarantine' ELSE 'out' END AS went,
      CASE WHEN lost THEN '' ELSE array_to_string(failed, '|') END AS failed FROM {_checked}""",
)
def stream_quality(spark, sf):
    folders = _checked_events(spark, sf, "quality")
    went = None
    for name in ("out", "dead", "quarantine"):
        df = spark.read.parquet(folders[name])
        failed = F.array_join("failed_checks", "|") if name == "quarantine" else F.lit("")
        part = df.select(F.col("key").cast("long").alias("event_id"), F.lit(name).alias("went"), failed.alias("failed"))
        went = part if went is None else went.unionByName(part)
    return went


@query(
    "stream_quality_counters",
    f"""SELECT 'read' AS counter, count(*) AS n FROM {_checked} UNION ALL
    SELECT 'unreadable', count(*) FROM {_checked} WHERE lost UNION ALL
    SELECT 'quarantined', count(*) FROM {_checked} WHERE NOT lost AND len(failed) > 0 UNION ALL
    SELECT 'delivered', count(*) FROM {_checked} WHERE NOT lost AND len(failed) = 0 UNION ALL
    SELECT unnest(failed), count(*) FROM {_checked} WHERE NOT lost GROUP BY 1""",
)
def stream_quality_counters(spark, sf):
    """The counters of all micro-batches added up."""
    counters = spark.read.parquet(_checked_events(spark, sf, "counters")["counters"])
    own = F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in ("read", "unreadable", "quarantined", "delivered")]))
    both = counters.select(own).unionByName(counters.select(F.explode("failed").alias("counter", "n")))
    return both.groupBy("counter").agg(F.sum("n").alias("n"))


@query(
    "log_consume",
    f"""SELECT CAST(event_id AS VARCHAR) AS key, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, user_id,
      {_type} AS event_type, value FROM events""",
)
def log_consume(spark, sf):
    """The events through a partitioned log, in two publications and two runs from one checkpoint."""
    base = scratch_path(spark, "log")
    for part in (0, 1):
        L.publish_log(_events(spark, sf).where(F.col("event_id") % 2 == part), f"{base}/topic", "event_id")
        run = S.consume(L.read_log(spark, f"{base}/topic"), EVENT, f"{base}/out", f"{base}/dead", f"{base}/position")
        run.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id", "part", "chunk", "rest", "record_position")


@query(
    "stream_batches",
    """WITH l AS (SELECT event_id % 8 AS lane, count(*) AS n FROM events GROUP BY 1),
      b AS (SELECT lane, unnest(range(0, n, 100)) // 100 AS batch, n FROM l)
    SELECT lane, CAST(batch AS BIGINT) AS batch, CASE WHEN (batch + 1) * 100 <= n THEN 'count' ELSE 'time' END AS closed_by,
      CAST(least(100, n - batch * 100) AS BIGINT) AS n FROM b""",
)
def stream_batches(spark, sf):
    """Batches that 100 rows or 5 seconds close, in 8 lanes of events that come in one micro-batch."""
    base = scratch_path(spark, "batches")
    publish_folder(_events(spark, sf), f"{base}/topic", "event_id")
    records = S.read_folder(spark, f"{base}/topic").select("key", "value")
    closed = close_batches(records, lane=F.col("key").cast("long"))
    finish(deliver_batches(closed, f"{base}/out", f"{base}/position"))
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("lane", "batch", "closed_by").agg(F.count_distinct("key").alias("n"))
