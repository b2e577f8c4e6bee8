"""Unions, duplicates, and incremental collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomart.operators.skew import first_per_key


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in all columns.

    Rows are compared by the SHA-256 of their JSON text, so that long texts are not
    shuffled; equal rows are already counted together before the shuffle.
    """
    digest = F.sha2(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), 256)
    return (
        df.select(digest.alias("d"))
        .groupBy("d")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    )


def collect_new(batch: DataFrame, seen: DataFrame, key: str, order_by: list[str | Column]) -> DataFrame:
    """The rows of ``batch`` whose key is present and not in ``seen``; first row per key."""
    fresh = first_per_key(batch.where(F.col(key).isNotNull()), [key], order_by)
    return fresh.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def enrich(hits: DataFrame, details: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(hits joined to their details, hits without details); details are unique on the key."""
    joined = hits.join(details.withColumn("__found", F.lit(True)), key, "left")
    found = joined.where(F.col("__found")).drop("__found")
    return found, joined.where(F.col("__found").isNull()).select(*hits.columns)


def work_list(areas: DataFrame, area: str, categories: list[str], done: DataFrame) -> DataFrame:
    """Every area with every category of the given list, without the pairs already done."""
    options = F.array(*[F.lit(c) for c in categories])
    todo = areas.select(area).distinct().select(area, F.explode(options).alias("category"))
    return todo.join(done.select(area, "category").distinct(), [area, "category"], "left_anti")
