from __future__ import annotations

import time
from datetime import datetime
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.streaming import batches as B
from geomart.streaming import log as L


def start(spark, base, **how):
    records = L.read_log(spark, f"{base}/t").select("key", "value", "offset")
    closed = B.close_batches(records, lane=F.col("key").cast("long"), **how)
    return B.deliver_batches(closed, f"{base}/out", f"{base}/position", every=0.3)


def publish(spark, base, lo, hi):
    return L.publish_log(spark.range(lo, hi), f"{base}/t", "id", partitions=2)


def batches(spark, base):
    out = spark.read.parquet(f"{base}/out")
    return rows(out.groupBy("lane", "batch", "closed_by").agg(F.count("*"), F.count_distinct("key"), F.min("place"), F.max("place")))


def test_count_closes_and_the_rest_waits_for_the_time(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, 0, 47)
    query = start(spark, base, rows=10, seconds=600, lanes=2)
    B.caught_up(query)
    query.stop()
    full = [(lane, batch, "count", 10, 10, 0, 9) for lane in (0, 1) for batch in (0, 1)]
    assert batches(spark, base) == full  # 4 and 3 rows wait in state
    publish(spark, base, 47, 60)
    query = start(spark, base, rows=10, seconds=600, lanes=2)  # a restart goes on with what waits
    B.caught_up(query)
    query.stop()
    assert batches(spark, base) == sorted([*full, (0, 2, "count", 10, 10, 0, 9), (1, 2, "count", 10, 10, 0, 9)])
    got = spark.read.parquet(f"{base}/out")
    assert sorted(int(r.key) for r in got.collect()) == list(range(60))
    assert got.schema["offset"].dataType.simpleString() == "bigint"


def test_time_closes_the_rest(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, base, 0, 25)
    query = start(spark, base, rows=10, seconds=2, lanes=1)
    began = time.time()
    B.finish(query, seconds=2)
    assert time.time() - began >= 2 and not query.isActive
    assert batches(spark, base) == [(0, 0, "count", 10, 10, 0, 9), (0, 1, "count", 10, 10, 0, 9), (0, 2, "time", 5, 5, 0, 4)]
    publish(spark, base, 25, 27)
    B.finish(start(spark, base, rows=10, seconds=2, lanes=1), seconds=2)
    assert batches(spark, base)[-1] == (0, 3, "time", 2, 2, 0, 1)


def test_names_that_are_taken(spark, tmp_path):
    publish(spark, str(tmp_path), 0, 3)
    with pytest.raises(ValueError, match="batch"):
        B.close_batches(L.read_log(spark, f"{tmp_path}/t").withColumnRenamed("key", "Batch"))


def test_values_stay_as_they_are_and_frames_are_bounded(spark, tmp_path):
    base = str(tmp_path)
    schema = "id long, big long, at timestamp, day date, price decimal(12,3), raw binary, tags array<int>, more map<string,long>, x double, t struct<a:int,b:timestamp>"
    at = datetime(2024, 3, 31, 1, 59, 59, 123456)
    every = [
        (i, None if i % 3 else 2**60 + i, None if i % 5 == 1 else at, at.date(), Decimal("1.250"), b"\x00\xff", [1, None], {"k": None, "l": 5}, None if i % 7 else float("nan"), (None, at) if i % 2 else None)
        for i in range(230)
    ]
    spark.createDataFrame(every, schema).coalesce(1).write.parquet(f"{base}/t")
    stream = spark.readStream.schema(schema).parquet(f"{base}/t")
    query = B.deliver_batches(B.close_batches(stream, lanes=1, lane=F.lit(0), seconds=1), f"{base}/out", f"{base}/p", every=0.3)
    B.finish(query, seconds=1)
    got = spark.read.parquet(f"{base}/out")
    assert got.drop("lane", "batch", "place", "closed_by", "micro_batch").schema.simpleString() == spark.read.parquet(f"{base}/t").schema.simpleString()
    assert rows(got.groupBy("batch", "closed_by").agg(F.count_distinct("place"))) == [(0, "count", 100), (1, "count", 100), (2, "time", 30)]
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct(*[c for c in schema_names]), {"ignoreNullFields": "false"})).collect())
    schema_names = spark.read.parquet(f"{base}/t").columns
    assert text(got) == text(spark.read.parquet(f"{base}/t"))


class Kept:
    """A state of one value or list, as the handle gives it."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    put = update = lambda self, value: setattr(self, "value", value)

    def clear(self):
        self.value = None


def test_a_lane_is_answered_frame_by_frame(spark):
    closer = B.Closer(T.StructType().add("v", "long"), 100, 5)
    closer.handle = SimpleNamespace(listTimers=list, registerTimer=lambda at: None)
    closer.waiting, closer.open = Kept(), Kept()
    read = []

    def frames():
        for k in range(20):
            read.append(k)
            yield pd.DataFrame({"batch_row": [{"v": k * 1050 + i} for i in range(1050)]})

    answers = closer.handleInputRows((0,), frames(), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 0))
    sizes = []
    for answer in answers:
        sizes.append((len(answer), len(read)))
    assert [k for _, k in sizes] == list(range(1, 21))  # an answer before the next frame is read
    assert max(n for n, _ in sizes) <= 1149 and sum(n for n, _ in sizes) == 21000
