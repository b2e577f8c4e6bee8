"""Rows to keyed JSON messages, and their publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.functions.dates import iso_text


def to_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """(key, value): one JSON object per row, missing values as JSON null, times as ISO text."""
    columns = [
        iso_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DatetimeType) else
        F.nanvl(f.name, F.lit(None).cast(f.dataType)).alias(f.name) if isinstance(f.dataType, T.FractionalType)
        and not isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    key_text = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(key_text.alias("key"), value.alias("value"))


def publish_kafka(df: DataFrame, topic: str, servers: str, key: str | None = None) -> tuple[bool, int]:
    """Send every row to a topic; (anything sent, rows sent). Needs Spark's Kafka connector.

    Acknowledgement by all replicas and retries are the producer's; a failed send fails the job.
    """
    sent = Observation()
    records = to_records(df, key).observe(sent, F.count(F.lit(1)).alias("rows"))
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", topic)
        .save()
    )
    rows = sent.get["rows"]
    return rows > 0, rows


def publish_folder(df: DataFrame, path: str, key: str | None = None) -> int:
    """The same records appended to a parquet folder; returns the rows sent."""
    sent = Observation()
    to_records(df, key).observe(sent, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return sent.get["rows"]
