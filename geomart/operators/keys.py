"""Positions without a global sort in one task: running totals, dense keys, code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.session import materialize


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed; breaks ties the same way in every run."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)])


def running_total(
    df: DataFrame, order_by: list[str], out: str, weight: str | None = None, ranges: int | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (1 per row by default) over all rows before this one.

    Rows are dealt into even ranges of ``order_by`` (ties by a hash of the row) and written once
    with the number of their range. Each range is then numbered on its own and shifted by the totals of
    the ranges before it. Range, totals and numbers all come from the written table, so a task
    that is run again gives the same. Costs a range shuffle, a write and the numbering shuffle.
    """
    tasks = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("__tie", row_hash(df))
    dealt = tied.repartitionByRange(tasks, *order_by, "__tie").withColumn("__range", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    amount = F.col(weight) if weight else F.lit(1)
    totals = dealt.groupBy("__range").agg(F.sum(amount).cast("long").alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("__shift"))
    in_order = Window.partitionBy("__range").orderBy(*order_by, "__tie")
    if weight:
        earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum(amount).over(earlier), F.lit(0)).cast("long")
    else:
        within = F.row_number().over(in_order).cast("long") - 1
    return (
        dealt.withColumn("__within", within)
        .join(F.broadcast(shifts), "__range")  # one row per range
        .withColumn(out, F.col("__shift") + F.col("__within"))
        .drop("__range", "__tie", "__within", "__shift")
    )


def dense_key(df: DataFrame, key: str, order_by: list[str], start: int | Column = 1) -> DataFrame:
    """Add a gap-free number from ``start`` in the order of ``order_by`` (equal rows in that order: by a hash of the row)."""
    numbered = running_total(df.drop(key), order_by, "__position")
    return numbered.withColumn(key, F.col("__position") + F.lit(start)).drop("__position")


def code_table(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """One row per distinct non-null value with a dense code from 0, in value order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return dense_key(values, code, [column], start=0)


def category_encode(df: DataFrame, column: str, code: str, limit: int = 50) -> DataFrame:
    """Add a dictionary code when the column has fewer than ``limit`` distinct values.

    With ``limit`` or more values the code is NULL: the column is not a category. At most
    ``limit`` distinct values are looked at to tell, and only a category is coded.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit).collect()
    if len(values) >= limit:
        return df.withColumn(code, F.lit(None).cast("long"))
    codes = code_table(df, column, code)
    return df.join(F.broadcast(codes), column, "left").select(*df.columns, code)  # fewer than limit rows
