"""Pivoted counts and their join back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_column(category: str, prefix: str = "count_nearby_") -> str:
    return prefix + category.replace("_&_", "_and_").replace(" ", "_")


def pivot_counts(
    df: DataFrame, index: str, category: str, value: str, categories: Sequence[str], prefix: str = "count_nearby_"
) -> DataFrame:
    """One row per index value, one column per listed category: count of non-null ``value``."""
    counts = df.groupBy(index).pivot(category, list(categories)).agg(F.count(value))
    return counts.select(
        index, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("int").alias(count_column(c, prefix)) for c in categories]
    )


def left_join_fill(left: DataFrame, counts: DataFrame, on: str) -> DataFrame:
    """Left join; a row without counts gets zeros."""
    new = [c for c in counts.columns if c != on]
    joined = left.join(counts, on, "left")
    return joined.select(*left.columns, *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in new])
