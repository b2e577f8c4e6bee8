"""Read keyed JSON messages, shape them, and deliver them in micro-batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from geomart.functions.dates import iso_utc_from_key
from geomart.functions.text import to_whole_number
from geomart.operators.quality import EXISTS, Suite, require_suite_columns, with_failures

RECORD = "key string, value string"
POSITION = ("partition", "offset", "timestamp")
# Delivery by 100 rows or every 5 seconds.
CHUNK_ROWS = 100
BATCH_SECONDS = 5


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_rows: int | None = None) -> DataFrame:
    """A topic as (key, value) text with each record's partition, offset and time. The checkpoint keeps the position."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_rows:
        reader = reader.option("maxOffsetsPerTrigger", max_rows)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"), *POSITION)


def read_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of records; a record's position is its file and its row in it."""
    reader = spark.readStream.schema(RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    at = F.col("_metadata")
    return reader.parquet(path).select(
        "key",
        "value",
        at["file_path"].alias("partition"),
        at["row_index"].alias("offset"),
        at["file_modification_time"].alias("timestamp"),
    )


def flag_from_json(value: Column, field: str) -> Column:
    """Python-like truth of one field: text is true when it reads ``true``, null stays NULL."""
    item = F.try_variant_get(F.try_parse_json(value), f"$.{field}", "variant")
    kind = F.schema_of_variant(item)
    text = F.get_json_object(value, f"$.{field}")
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("boolean"))
        .when(kind.isin("STRING", "BOOLEAN"), F.lower(text) == "true")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.isin("[]", "{}"))
        .otherwise(text.try_cast("double") != 0)
    )


def decode(records: DataFrame, schema: T.StructType) -> DataFrame:
    """(key, value, row, bad) and the record's position: the parsed message, and whether it is no usable JSON object."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    row = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    place = [c for c in POSITION if c in records.columns]
    parsed = records.select("key", "value", *place, row.alias("row"))
    is_object = F.trim("value").startswith("{") & (F.regexp_replace("value", r"\s", "") != "{}")
    good = is_object & F.col("row").isNotNull() & F.col("row._corrupt").isNull()
    return parsed.withColumn("bad", ~F.coalesce(good, F.lit(False)))


def shape(
    decoded: DataFrame,
    schema: T.StructType,
    dates: tuple[str, ...] = ("last_review",),
    flags: tuple[str, ...] = ("host_verification", "instant_bookable_flag"),
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns of good messages: dates as ISO text, flags as booleans, names by the map.

    Fields that ``schema`` doesn't declare pass through in the map ``rest`` (name to value, nested
    ones as JSON text). Stateless, so the same function serves a table and a stream. Date
    and flag fields are to be declared as strings in ``schema``.
    """
    columns = []
    for f in schema.fields:
        c = F.col(f"row.{f.name}")
        if f.name in dates:
            c = iso_utc_from_key(to_whole_number(c))
        elif f.name in flags:
            c = flag_from_json(F.col("value"), f.name)
        columns.append(c.alias((names or {}).get(f.name, f.name)))
    every = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    rest = F.map_filter(every, lambda name, _: ~name.isin(*schema.names)).alias("rest")
    place = F.struct(*[c for c in POSITION if c in decoded.columns]).alias("record_position")
    return decoded.where(~F.col("bad")).select("key", *columns, rest, *([place] if "offset" in decoded.columns else []))


def with_chunk(df: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the rows of each partition in chunks of at most ``rows``, without a shuffle."""
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn("part", F.spark_partition_id()).withColumn("chunk", F.floor(in_partition / rows))


def tally(decoded: DataFrame, marked: DataFrame | None, labels: Sequence[str]) -> DataFrame:
    """One row of counters of a micro-batch: records read, unreadable, quarantined and delivered, and per check the
    rows that failed it."""
    counts = decoded.agg(F.count(F.lit(1)).alias("read"), F.count_if("bad").alias("unreadable"))
    if marked is None:
        counts = counts.withColumn("quarantined", F.lit(0).cast("long"))
    else:
        held = F.count_if(F.size("failed_checks") > 0).alias("quarantined")
        per_check = [F.count_if(F.array_contains("failed_checks", label)) for label in labels]
        failed = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.array(*per_check)).alias("failed")
        counts = counts.crossJoin(marked.agg(held, failed))  # one row each
    return counts.withColumn("delivered", F.col("read") - F.col("unreadable") - F.col("quarantined"))


def consume(
    records: DataFrame,
    schema: T.StructType,
    out: str,
    dead: str,
    checkpoint: str,
    *,
    drain: bool = True,
    names: Mapping[str, str] | None = None,
    suite: Suite | None = None,
    quarantine: str | None = None,
    counters: str | None = None,
):
    """Start the query: good rows to ``out``, messages that cannot be read to ``dead``.

    With a ``suite`` each micro-batch passes it row by row: rows that fail a check go to ``quarantine`` with the labels of the
    checks, the others to ``out``. A suite on a column that messages don't declare is refused at the start. ``counters`` gets
    one row per micro-batch (see :func:`tally`).

    Each micro-batch overwrites its own ``batch_id`` folder everywhere, so a repeated batch writes the
    same rows again instead of more. ``drain`` takes all that is there and stops;
    otherwise a batch starts every 5 seconds.
    """
    if (suite is None) != (quarantine is None):
        raise ValueError("a suite needs a quarantine folder, and the other way round")
    if suite:
        require_suite_columns([(names or {}).get(f, f) for f in schema.names], suite)
    labels = [e.label for e in suite.expectations if e.kind != EXISTS] if suite else []

    def deliver(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch, schema).persist()
        try:
            good, marked = shape(decoded, schema, names=names), None
            if suite:
                marked = with_failures(good, suite)
                passed = F.size("failed_checks") == 0
                marked.where(~passed).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
                good = marked.where(passed).drop("failed_checks")
            with_chunk(good).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            lost = decoded.where("bad").select("key", "value", *[c for c in POSITION if c in decoded.columns])
            lost.write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
            if counters:
                tally(decoded, marked, labels).write.mode("overwrite").parquet(f"{counters}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    writer = records.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{BATCH_SECONDS} seconds")
    return writer.start()


def delivered(query: StreamingQuery) -> tuple[int, int]:
    """(batches, rows read) of a query so far, from Spark's own progress reports."""
    done = [p for p in query.recentProgress if p["numInputRows"]]
    return len(done), sum(p["numInputRows"] for p in done)
