from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.operators import quality as Q
from geomart.streaming import consume as S
from geomart.streaming.records import publish_folder, to_records

SAMPLE = [(101, 1, 100.0, "Cozy", 1.5, 20230115), (102, 2, 150.5, "Sunny", None, 22620411), (103, 1, 90.0, None, float("nan"), None)]
FIELDS = "publication_key int, host_id int, price double, name string, reviews_per_month double, last_review int"
SCHEMA = (
    T.StructType()
    .add("publication_key", "long")
    .add("host_id", "long")
    .add("price", "double")
    .add("name", "string")
    .add("reviews_per_month", "double")
    .add("last_review", "string")
)


def sample(spark):
    return spark.createDataFrame(SAMPLE, FIELDS)


def test_records_keep_nulls_and_iso_times(spark):
    got = {r.key: json.loads(r.value) for r in to_records(sample(spark), "publication_key").collect()}
    assert got["102"]["reviews_per_month"] is None and got["103"]["name"] is None
    assert got["103"]["reviews_per_month"] is None
    timed = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS t, date'2024-01-02' AS d")
    assert json.loads(to_records(timed).first().value) == {"t": "2024-01-02T03:04:05", "d": "2024-01-02T00:00:00"}
    assert to_records(timed).first().key is None


def test_publish_counts_and_empty(spark, tmp_path):
    assert publish_folder(sample(spark), str(tmp_path / "t"), "publication_key") == 3
    assert publish_folder(sample(spark).limit(0), str(tmp_path / "e")) == 0


@pytest.mark.parametrize(
    "raw, want",
    [('"TRUE"', True), ('"yes"', False), ("true", True), ("false", False), ("1", True), ("0", False), ('"1"', False), ("null", None), ("[]", False), ("[0]", True), ("0.5", True)],
)
def test_flag_truth(spark, raw, want):
    df = spark.createDataFrame([('{"f": %s}' % raw,)], "value string")
    assert df.select(S.flag_from_json(F.col("value"), "f")).first()[0] == want


def test_flag_absent(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    assert df.select(S.flag_from_json(F.col("value"), "f")).first()[0] is None


def run(spark, base):
    query = S.consume(S.read_folder(spark, f"{base}/topic"), SCHEMA, f"{base}/out", f"{base}/dead", f"{base}/position")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_stream_equals_batch_and_restart_adds_only_new(spark, tmp_path):
    base = str(tmp_path)
    publish_folder(sample(spark), f"{base}/topic", "publication_key")
    columns = ["key", *SCHEMA.names]
    batch = S.shape(S.decode(spark.read.parquet(f"{base}/topic"), SCHEMA), SCHEMA)
    assert rows(run(spark, base).select(*columns)) == rows(batch.select(*columns))
    assert run(spark, base).count() == 3
    publish_folder(sample(spark).where("publication_key = 101"), f"{base}/topic", "publication_key")
    again = run(spark, base)
    assert again.count() == 4
    assert {r.last_review for r in again.collect()} == {"2023-01-15T00:00:00Z", None}


def test_bad_messages_go_to_dead_letters(spark, tmp_path):
    base = str(tmp_path)
    values = ["no json", "[1]", "5", '"text"', "{}", None, '{"host_id": "x"}', '{"host_id": 4}']
    records = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    records.write.parquet(f"{base}/topic")
    assert [r.host_id for r in run(spark, base).collect()] == [4]
    dead = spark.read.parquet(f"{base}/dead")
    assert rows(dead.select("key")) == [(str(i),) for i in range(7)]
    written = {r.key: r.value for r in records.collect()}
    for r in dead.collect():  # the position leads back to the record
        at = spark.read.parquet(r.partition).where(F.col("_metadata.row_index") == r.offset).first()
        assert (at.key, at.value) == (r.key, written[r.key])


def test_counters_and_undeclared_fields(spark, tmp_path):
    base = str(tmp_path)
    values = ['{"host_id": 4, "extra": "kept", "deep": {"a": [1]}}', '{"host_id": 5}', "bad"]
    spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string").write.parquet(f"{base}/topic")
    query = S.consume(S.read_folder(spark, f"{base}/topic"), SCHEMA, f"{base}/out", f"{base}/dead", f"{base}/position")
    query.awaitTermination()
    assert S.delivered(query) == (1, 3)
    rest = {r.host_id: r.rest for r in spark.read.parquet(f"{base}/out").collect()}
    assert rest == {4: {"extra": "kept", "deep": '{"a":[1]}'}, 5: {}}


def test_chunks_hold_at_most_n_rows(spark):
    chunked = S.with_chunk(spark.range(0, 1050, 1, 4), 100)
    sizes = chunked.groupBy("part", "chunk").count()
    assert sizes.agg(F.max("count"), F.sum("count"), F.count("*")).first() == (100, 1050, 12)


CHECKED = Q.Suite("s", (Q.Expectation(Q.BETWEEN, "price", 95, 1000), Q.Expectation(Q.NOT_NULL, "name"), Q.Expectation(Q.EXISTS, "host_id")))


def run_checked(spark, base):
    query = S.consume(
        S.read_folder(spark, f"{base}/topic"), SCHEMA, f"{base}/out", f"{base}/dead", f"{base}/position",
        suite=CHECKED, quarantine=f"{base}/held", counters=f"{base}/counters",
    )
    query.awaitTermination()


def totals(spark, base):
    c = spark.read.parquet(f"{base}/counters")
    return tuple(c.agg(*[F.sum(x) for x in ("read", "unreadable", "quarantined", "delivered")]).first())


def test_rows_that_fail_a_check_are_quarantined(spark, tmp_path):
    base = str(tmp_path)
    publish_folder(sample(spark), f"{base}/topic", "publication_key")
    run_checked(spark, base)
    assert rows(spark.read.parquet(f"{base}/out").select("publication_key")) == [(101,), (102,)]
    held = spark.read.parquet(f"{base}/held").first()
    assert (held.publication_key, held.failed_checks) == (103, [f"{Q.BETWEEN}:price", f"{Q.NOT_NULL}:name"])
    assert held.record_position.offset >= 0 and totals(spark, base) == (3, 0, 1, 2)
    assert spark.read.parquet(f"{base}/counters").first().failed == {f"{Q.BETWEEN}:price": 1, f"{Q.NOT_NULL}:name": 1}


def test_a_restart_and_a_repeated_batch_keep_quarantine_and_counters(spark, tmp_path):
    base = str(tmp_path)
    publish_folder(sample(spark), f"{base}/topic", "publication_key")
    run_checked(spark, base)
    run_checked(spark, base)  # nothing new
    assert totals(spark, base) == (3, 0, 1, 2)
    spark.createDataFrame([("9", "bad"), ("8", '{"price": 1, "name": "x"}')], "key string, value string").write.mode("append").parquet(f"{base}/topic")
    run_checked(spark, base)
    assert totals(spark, base) == (5, 1, 2, 2)
    last = max((tmp_path / "position" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.unlink()  # as if the driver had died before the last batch was noted as done
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run_checked(spark, base)
    assert totals(spark, base) == (5, 1, 2, 2)
    assert [spark.read.parquet(f"{base}/{n}").count() for n in ("out", "held", "dead")] == [2, 2, 1]


def test_suites_that_cannot_be_checked_are_refused(spark, tmp_path):
    args = spark.readStream.format("rate").load(), SCHEMA, str(tmp_path), str(tmp_path), str(tmp_path)
    with pytest.raises(Q.QualityError, match="rating"):
        S.consume(*args, suite=Q.Suite("s", (Q.Expectation(Q.NOT_NULL, "rating"),)), quarantine="q")
    with pytest.raises(ValueError, match="quarantine"):
        S.consume(*args, suite=CHECKED)
