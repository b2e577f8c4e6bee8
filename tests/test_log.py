from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.streaming import consume as S
from geomart.streaming import log as L

SCHEMA = T.StructType().add("id", "long").add("v", "long")


def publish(spark, topic, lo, hi, **more):
    return L.publish_log(spark.range(lo, hi).withColumn("v", F.col("id") * 2), topic, "id", **more)


def test_offsets_are_dense_and_stay(spark, tmp_path):
    topic = str(tmp_path / "t")
    assert publish(spark, topic, 0, 500, partitions=3, segment_rows=70) == 500
    once = {(r.partition, r.offset): r.key for r in L.read_log(spark, topic, stream=False).collect()}
    assert publish(spark, topic, 500, 530, partitions=3) == 30
    df = L.read_log(spark, topic, stream=False)
    twice = {(r.partition, r.offset): r.key for r in df.collect()}
    assert once.items() <= twice.items() and len(twice) == 530 == df.count()
    assert sorted(map(int, twice.values())) == list(range(530))
    for p in range(3):
        assert sorted(o for q, o in twice if q == p) == list(range(sum(q == p for q, _ in twice)))
    assert L.latest(topic) == {str(p): sum(q == p for q, _ in twice) for p in range(3)}
    assert all(hi - lo <= 70 for parts in L.segments(topic).values() for lo, hi, _ in parts)


def test_parts_of_segments(spark, tmp_path):
    topic = str(tmp_path / "t")
    publish(spark, topic, 0, 300, partitions=2, segment_rows=50)
    every = {(r.partition, r.offset): r.value for r in L.read_log(spark, topic, stream=False).collect()}
    top = L.latest(topic)
    for start, end in (({"0": 3, "1": 77}, {"0": 60, "1": 78}), ({}, top), (top, top), ({"0": 49}, {"0": 51})):
        got = [(p, o, v) for s in L.between(topic, start, end) for b in L.read_segment(topic, s) for p, o, v in zip(*(b.column(c).to_pylist() for c in ("partition", "offset", "value")))]
        want = [(p, o, v) for (p, o), v in every.items() if start.get(str(p), 0) <= o < end.get(str(p), 0)]
        assert sorted(got) == sorted(want)


def consume(spark, base, starting="earliest"):
    query = S.consume(L.read_log(spark, f"{base}/t", starting), SCHEMA, f"{base}/out", f"{base}/dead", f"{base}/position")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_consume_stop_resume(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, f"{base}/t", 0, 200, partitions=3)
    assert rows(consume(spark, base).select("id", "v")) == rows(spark.range(200).selectExpr("id", "id * 2"))
    assert consume(spark, base).count() == 200  # nothing new
    publish(spark, f"{base}/t", 200, 260, partitions=5)  # two more partitions
    publish(spark, f"{base}/t", 260, 300, partitions=3)
    got = consume(spark, base)
    assert rows(got.select("id", "v")) == rows(spark.range(300).selectExpr("id", "id * 2"))
    places = got.select("record_position.partition", "record_position.offset").distinct()
    assert places.count() == 300


def test_latest_skips_what_is_there(spark, tmp_path):
    base = str(tmp_path)
    publish(spark, f"{base}/t", 0, 100)
    consume(spark, base, "latest")
    publish(spark, f"{base}/t", 100, 130)
    assert rows(consume(spark, base, "latest").select("id")) == [(i,) for i in range(100, 130)]


def test_a_failed_publication_shows_nothing(spark, tmp_path):
    topic = str(tmp_path / "t")
    publish(spark, topic, 0, 50)
    bad = spark.range(100).withColumn("v", F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        L.publish_log(bad, topic, "id")
    assert L.read_log(spark, topic, stream=False).count() == 50
    assert publish(spark, topic, 50, 60) == 10 and L.read_log(spark, topic, stream=False).count() == 60
    assert L.publish_log(spark.range(0), topic) == 0 and L.read_log(spark, str(tmp_path / "none"), stream=False).count() == 0


def test_keys_keep_their_partition(spark, tmp_path):
    topic = str(tmp_path / "t")
    for _ in range(2):
        publish(spark, topic, 0, 60, partitions=4)
    df = L.read_log(spark, topic, stream=False)
    assert df.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
