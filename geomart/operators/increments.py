"""Profiles that grow by batches: each batch leaves one small row per column, and a profile of all batches is
made from these rows without reading the data again.

Counts, extremes, mean and deviation are exact (up to the rounding of sums); distinct values and quantiles come from
sketches that merge: a HyperLogLog sketch with a standard error of about 1.6 %, and a KLL sketch whose quantiles lie
within about 1.7 % of the rank asked for. The rows of a column are a few KB however large the batch is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12
KLL_SIZE = 200
QUANTILES = (0.25, 0.5, 0.75)


def partial_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One mergeable row per column of a batch, from one scan.

    NULL and NaN are missing. Columns that aren't numbers have no mean, deviation, extremes or quantiles.
    A batch without rows gives rows that change nothing.
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in columns:
        numeric = isinstance(kinds[c], T.NumericType)
        value = F.col(c)
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None))
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        kll = F.kll_sketch_agg_double(number, KLL_SIZE) if numeric else F.lit(None).cast("binary")
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("rows"),
                F.count(value).alias("present"),
                F.avg(number).alias("mean"),
                (F.var_pop(number) * F.count(number)).alias("m2"),
                F.min(number).alias("least"),
                F.max(number).alias("most"),
                F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias("hll"),
                kll.alias("kll"),
            )
        )
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Rows of many batches as one mergeable row per column; merging in steps gives the same as at once."""
    means = parts.groupBy("column_name").agg((F.sum(F.col("mean") * F.col("present")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("present")))).alias("middle"))
    own = parts.join(F.broadcast(means), "column_name")  # one row per column
    apart = F.col("mean") - F.col("middle")
    return own.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.first("middle").alias("mean"),
        F.sum(F.col("m2") + F.col("present") * apart * apart).alias("m2"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"),
    )


def profile_of(merged: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``column_name, rows, null_count, null_percent, mean, std, least, most, approx_distinct`` and a column per quantile."""

    def quantile(q: float) -> Column:
        numbers = F.col("mean").isNotNull()
        return F.when(numbers, F.kll_sketch_get_quantile_double("kll", F.lit(q))).alias(f"approx_q{round(q * 100)}")

    nulls = F.col("rows") - F.col("present")
    return merged.select(
        "column_name",
        "rows",
        nulls.alias("null_count"),
        F.try_divide(nulls * 100.0, "rows").alias("null_percent"),
        "mean",
        F.when(F.col("present") > 1, F.sqrt(F.col("m2") / (F.col("present") - 1))).alias("std"),
        "least",
        "most",
        F.hll_sketch_estimate("hll").alias("approx_distinct"),
        *[quantile(q) for q in quantiles],
    )


@dataclass(frozen=True)
class ProfileStore:
    """The rows of all batches in a folder; a batch added again replaces its own rows."""

    spark: SparkSession
    path: str

    def add(self, batch_id: str, df: DataFrame, columns: Sequence[str] | None = None) -> None:
        partial_profile(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def drop(self, batch_id: str) -> None:
        """Forget a batch that was withdrawn: its rows are replaced by none."""
        self.parts().where("false").drop("batch_id").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def parts(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def exists(self) -> bool:
        try:
            self.parts()
        except AnalysisException:
            return False
        return True

    def profile(self, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
        return profile_of(merge_profiles(self.parts().drop("batch_id")), quantiles)
