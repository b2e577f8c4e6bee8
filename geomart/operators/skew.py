"""Joins and picks that stay even when one key holds a large share of the rows.

A plain join is the rule: with ``spark.sql.adaptive.skewJoin.enabled`` (set by the session helper,
and Spark's default) a key's rows are split by the map output they come from, so equal rows and columns of
any type are split too, and no key has to be counted beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomart.operators.keys import row_hash


def spread_keys(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``__salt``: rows of the keys in ``hot`` are dealt over their ``pieces``, all others get 0.

    Rows are dealt by their place in the partition, so that equal rows are spread as well. Which
    of its copies of the right row a row meets doesn't change the result.
    """
    place = F.monotonically_increasing_id()
    dealt = F.pmod(place, F.coalesce("pieces", F.lit(1))).cast("int")
    return df.join(hot.select(*on, "pieces"), on, "left").withColumn("__salt", dealt).drop("pieces")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """Inner or left join where the caller knows the hot left keys: ``hot`` holds ``on`` and ``pieces``.

    Each key is dealt over as many tasks as its row says (its rows over what a task should hold),
    and only its rows of the right side are repeated. For joins outside adaptive execution, as in a
    stream; elsewhere a plain join does it.
    """
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)).cast("int") - 1))
    repeated = right.join(hot.select(*on, "pieces"), on, "left").withColumn("__salt", copies).drop("pieces")
    return spread_keys(left, on, hot).join(repeated, [*on, "__salt"], how).drop("__salt")


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key, equal ones in the order by a hash of the row.

    Each map task keeps ``n`` rows per key before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by, "__tie"))
    ranked = df.withColumn("__tie", row_hash(df)).withColumn("__rank", rank)
    return ranked.where(F.col("__rank") <= n).drop("__rank", "__tie")
