from __future__ import annotations

from pyspark.sql import functions as F

from geomart.llm import compression as C

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = C.predict(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.85 * len(bad)
    assert abs(sum(r.score for r in rows) / len(rows) - len(good) / len(rows)) < 0.08  # calibrated on the whole


def test_every_row_gets_a_score(docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = C.predict(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(~C.learnable(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in C.predict(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in C.predict(docs, turned).collect()}


def test_labels_missing_or_of_one_class(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in C.predict(docs, none).select("score").distinct().collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, None) for i in range(50)] + [(None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert C.predict(docs, one).where("predicted = 0").count() == 0
    assert C.predict(docs.where(F.lit(False)), one).count() == 0


def test_filter_keeps_columns(docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = C.keep_good(docs, labels)
    kept = C.predict(docs, labels).where("predicted = 1").count()
    assert out.columns == docs.columns and out.count() == kept


def test_the_model_does_not_follow_the_order_of_rows(spark):
    rows = [(i % 30, f"text {i} " * (1 + i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    models = [C.train(d, labels) for d in (df.coalesce(1), df.repartition(5, "text"), df.orderBy(F.desc("text")))]
    assert all((m.good, m.bad) == (models[0].good, models[0].bad) and (m.weights == models[0].weights).all() for m in models)
