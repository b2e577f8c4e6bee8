from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from geomart.session import materialize
from geomart.sources.seen import SeenIds


@pytest.fixture
def seen(spark, tmp_path):
    made = SeenIds(spark, f"seen_{tmp_path.name}", "id", 8).create(spark.range(0), str(tmp_path / "ids"))
    yield made
    for name in (made.table, f"{made.table}_compact"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch(spark, lo, hi):
    df = spark.range(lo, hi).withColumn("v", F.col("id") * 3)
    return df.unionByName(df.withColumn("v", F.col("v") + 1)).unionByName(spark.createDataFrame([(None, 1)], "id long, v long"))


def test_batches_add_only_new_ids(spark, seen):
    for lo, hi, want in ((0, 50, range(0, 50)), (30, 70, range(50, 70)), (0, 70, ())):
        new = materialize(seen.fresh(batch(spark, lo, hi), ["v"]), "new")
        assert rows(new) == sorted(((i, i * 3) for i in want), key=lambda r: (str(r[0]), str(r[1])))
        seen.add(new)
    assert rows(seen.ids()) == sorted(((i,) for i in range(70)), key=lambda r: str(r[0]))
    seen.add(spark.range(10))  # twice is as once
    assert seen.fresh(batch(spark, 0, 70), ["v"]).isEmpty()
    compact = seen.compact()
    assert compact.ids().count() == 70 and compact.fresh(batch(spark, 60, 72), ["v"]).count() == 2


def test_the_history_is_not_shuffled(spark, seen):
    seen.add(spark.range(5000))
    joined = seen.fresh(batch(spark, 4990, 5010), ["v"])
    assert joined.count() == 10
    plan = joined._jdf.queryExecution().executedPlan().toString()
    batch_side, history = plan.rsplit("Sort [__seen", 1)
    assert "SortMergeJoin" in batch_side and "Exchange hashpartitioning(id" in batch_side
    assert "Bucketed: true" in history and "Exchange" not in history.split("Initial Plan")[0]
