"""Profiling. Each function makes one DataFrame; scans are shared inside it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from geomart.operators.columns import columns_of_type
from geomart.operators.keys import running_total


def value_counts(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    rows = df if with_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_n_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values, ties to the smaller value, listed in value order."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(n).orderBy("value")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    return df.select(*[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )


def distinct_profile(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column, with NULL left out and counted as a value.

    The exact form counts each (column, value) once after a partial aggregation; the
    approximate one is a single pass with fixed memory.
    """
    if approx:
        stats = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.approx_count_distinct(c).alias("n_unique"),
                (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias("n_unique_with_null"),
            )
            for c in columns
        ]
        return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    seen = _long(df, columns, "string").distinct()
    return seen.groupBy("column_name").agg(
        F.count("value").alias("n_unique"), F.count(F.lit(1)).alias("n_unique_with_null")
    )


def null_profile(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """NULL count and share per column, one pass, most NULLs first."""
    stats = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            (F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))).alias("null_percent"),
        )
        for c in df.columns
    ]
    table = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    if only_with_nulls:
        table = table.where(F.col("null_count") > 0)
    return table.orderBy(F.desc("null_count"), "column_name")


def table_info(df: DataFrame) -> DataFrame:
    """Type, rows and non-null rows per column."""
    stats = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(f.name).alias("non_null_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


SKETCH_ACCURACY = 10_000


def _sketch(df: DataFrame, columns: Sequence[str], shares: Sequence[float], accuracy: int) -> dict[str, Row]:
    """Per column with values: count, mean, deviation, range, and values around each share, in one wide pass.

    The values come from a sketch of fixed size, whose rank error is at most ``1/accuracy`` of the rows,
    with room to spare on both sides. NULL and NaN are left out. One small row per column is returned.
    """
    room = 4 / accuracy
    ends = [e for s in shares for e in (max(0.0, s - room), min(1.0, s + room))]
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        parts.append(
            F.struct(
                F.count(v).alias("n"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
                F.percentile_approx(v, ends, accuracy).alias("ends"),
            )
        )
    row = df.agg(F.array(*parts).alias("s")).first()
    return {c: r for c, r in zip(columns, row.s) if r.n}


def _counts_around(values: DataFrame, sketch: dict[str, Row]) -> DataFrame:
    """(column_name, value, n): exact counts near the wanted quantiles, lump counts elsewhere.

    Only values between the two ends of a share are counted one by one; all values of a gap
    between become one row under their smallest value, so ranks stay exact.
    """
    pairs = [(F.lit(c), F.array(*[F.lit(float(e)) for e in r.ends])) for c, r in sketch.items()]
    ends = F.create_map(*[x for pair in pairs for x in pair])[F.col("column_name")]
    values = values.withColumn("ends", ends)
    near, gap = F.lit(False), F.lit(0)
    for i in range(0, len(next(iter(sketch.values())).ends), 2):
        near = near | F.col("value").between(F.col("ends")[i], F.col("ends")[i + 1])
        gap = gap + (F.col("value") > F.col("ends")[i + 1]).cast("int")
    return (
        values.groupBy("column_name", gap.alias("gap"), F.when(near, F.col("value")).alias("single"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"))
        .select("column_name", "value", "n")
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    names: Sequence[str],
    accuracy: int = SKETCH_ACCURACY,
    sketch: dict[str, Row] | None = None,
) -> DataFrame:
    """(column_name, *names): quantiles with linear interpolation, NULL and NaN left out.

    Two scans: a sketch brackets the quantiles (``sketch``, if the caller has made it), then the
    values near them are counted. Ranks come from a running total over the counts, so no task sees a whole column.
    """
    sketch = _sketch(df, columns, shares, accuracy) if sketch is None else sketch
    if not sketch:
        schema = "column_name string, " + ", ".join(f"{n} double" for n in names)
        return df.sparkSession.createDataFrame([], schema)
    values = _long(df, list(sketch), "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = _counts_around(values, sketch)
    ranked = running_total(counted, ["column_name", "value"], "before", weight="n")
    sizes = ranked.groupBy("column_name").agg(F.min("before").alias("start"), F.sum("n").alias("total"))
    placed = ranked.join(F.broadcast(sizes), "column_name").withColumn("before", F.col("before") - F.col("start"))

    def at(position: Column) -> Column:
        here = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    picks = []
    for share, name in zip(shares, names):
        exact = F.lit(share) * (F.col("total") - 1)
        picks += [at(F.floor(exact)).alias(f"{name}_lo"), at(F.ceil(exact)).alias(f"{name}_hi")]
    found = placed.groupBy("column_name", "total").agg(*picks)
    return found.select(
        "column_name",
        *[
            (
                F.col(f"{name}_lo")
                + (F.col(f"{name}_hi") - F.col(f"{name}_lo"))
                * (F.lit(share) * (F.col("total") - 1) - F.floor(F.lit(share) * (F.col("total") - 1)))
            ).alias(name)
            for share, name in zip(shares, names)
        ],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column.

    Two scans: one wide pass for all figures and the sketch, one for the quartiles; ``approx`` stays
    with the sketch of the first.
    """
    columns = list(columns or columns_of_type(df, "numeric"))
    shares, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    sketch = _sketch(df, columns, shares, SKETCH_ACCURACY)
    schema = "column_name string, n long, mean double, std double, min double, max double"
    rows = [(c, r.n, r["mean"], r["std"], r["min"], r["max"]) for c, r in sketch.items()]
    basic = df.sparkSession.createDataFrame(rows, schema)
    if approx:
        middle = [(c, *[(r.ends[2 * i] + r.ends[2 * i + 1]) / 2 for i in range(3)]) for c, r in sketch.items()]
        quartiles = df.sparkSession.createDataFrame(middle, "column_name string, q25 double, q50 double, q75 double")
    else:
        quartiles = exact_quantiles(df, columns, shares, names, sketch=sketch)
    table = basic.join(F.broadcast(quartiles), "column_name")  # a row per column
    return table.select("column_name", "n", "mean", "std", "min", *names, "max")


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, most frequent value and its count per column; ties to the smaller value."""
    columns = list(columns or columns_of_type(df, "string"))
    counted = (
        _long(df, columns, "string").where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
            F.count(F.lit(1)).alias("c")
        )
    )
    most = F.col("c") == F.col("freq")
    sums = counted.groupBy("column_name").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_unique"), F.max("c").alias("freq")
    )
    return (
        counted.join(F.broadcast(sums), "column_name")
        .where(most)
        .groupBy("column_name", "n", "n_unique", "freq")
        .agg(F.min("value").alias("top"))
        .select("column_name", "n", "n_unique", "top", "freq")
    )


def describe_datetime(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, min, quartiles and max per date or time column, as timestamps.

    The quartiles are taken over microseconds since 1970, which doubles hold exactly
    until the year 2255.
    """
    columns = list(columns or columns_of_type(df, "datetime"))
    micros = df.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in columns])
    numbers = _long(micros, columns, "long").where(F.col("value").isNotNull())
    quartiles = exact_quantiles(micros, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    basic = numbers.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    as_time = lambda c: F.timestamp_micros(F.floor(c).cast("long")).alias(c)
    return basic.join(F.broadcast(quartiles), "column_name").select(
        "column_name", "n", *[as_time(c) for c in ("mean", "min", "q25", "q50", "q75", "max")]
    )


def most_active_year(df: DataFrame, column: str) -> DataFrame:
    """The year with most rows and its count; a tie goes to the earlier year."""
    years = df.where(F.col(column).isNotNull()).groupBy(F.year(column).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.col("year")).alias("first"))).alias("b")
    return years.agg(best).select((-F.col("b.first")).alias("year"), F.col("b.n").alias("n"))


def skewness_log_rule(df: DataFrame, columns: Sequence[str], limit: float = 2.0) -> DataFrame:
    """Bias-corrected skewness per column and which logarithm fits a strongly skewed one."""
    values = _long(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    stats = values.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.skewness("value").alias("g"),
        F.count_if(F.col("value") < 0).alias("below"),
        F.count_if(F.col("value") == 0).alias("zeros"),
    )
    n = F.col("n")
    skew = F.when(n > 2, F.col("g") * F.sqrt((n * (n - 1)).cast("double")) / (n - 2))
    transform = (
        F.when(F.abs("skewness") <= limit, F.lit("none"))
        .when((F.col("below") > 0) | (F.col("zeros") == n), F.lit("not possible"))
        .when(F.col("zeros") > 0, F.lit("log1p"))
        .otherwise(F.lit("log"))
    )
    return (
        stats.withColumn("skewness", skew)
        .where(F.col("skewness").isNotNull())
        .select("column_name", "skewness", "below", "zeros", transform.alias("transform"))
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) for equal-width bins from minimum to maximum; empty bins listed."""
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    span = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s"))
    placed = values.withColumn("span", span.scalar())
    # A constant column has its single bar in a span of width one around the value.
    flat = F.col("span.hi") == F.col("span.lo")
    low = F.when(flat, F.col("span.lo") - 0.5).otherwise(F.col("span.lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("span.hi") - F.col("span.lo")) / bins
    bin_no = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = (
        span.where(F.col("s.lo").isNotNull())
        .select(F.col("s").alias("span"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select("bin", (low + width * F.col("bin")).alias("low"), (low + width * (F.col("bin") + 1)).alias("high"))
    )
    return frame.join(F.broadcast(counts), "bin", "left").select(  # counts: at most one row per bin
        "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last values within ``reach`` times the quartile range, outliers."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    values = _long(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    span = (F.col("q75") - F.col("q25")) * reach
    inside = (F.col("value") >= F.col("q25") - span) & (F.col("value") <= F.col("q75") + span)
    kept = F.when(inside, F.col("value"))
    return (
        values.join(F.broadcast(quartiles), "column_name")
        .groupBy("column_name", "q25", "q50", "q75")
        .agg(
            F.least(F.min(kept), "q25").alias("whisker_low"),
            F.greatest(F.max(kept), "q75").alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def kde_curve(df: DataFrame, column: str, points: int = 200, approx: bool = False, bins: int = 512) -> DataFrame:
    """(point, x, density): Gaussian density of all rows with Scott's bandwidth over an even grid.

    Each task adds the rows it reads up into one sum per grid point, so memory doesn't depend on the
    table and only the sums are shuffled. ``approx`` counts the rows into ``bins`` narrow bars first and spreads
    the bars, so that the work after the count doesn't grow with the table.
    """
    if approx:
        return _kde_of_bars(df, column, points, bins)
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    s = values.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    schema = "point int, total double"
    if not s.n or not s.sd:
        nothing = df.sparkSession.createDataFrame([], "point int, x double, density double")
        return nothing
    width = s.sd * s.n**-0.2
    grid = s.lo + (s.hi - s.lo) / (points - 1) * np.arange(points)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(points)
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(v), 1024):
                total += np.exp(-0.5 * ((grid[:, None] - v[None, i : i + 1024]) / width) ** 2).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points, dtype=np.int32)), pa.array(total)], names=["point", "total"])

    added = values.mapInArrow(sums, schema).groupBy("point").agg(F.sum("total").alias("total"))
    at = F.lit(s.lo) + F.lit((s.hi - s.lo) / (points - 1)) * F.col("point")
    return added.select("point", at.alias("x"), (F.col("total") / (s.n * width * math.sqrt(2 * math.pi))).alias("density"))


def _kde_of_bars(df: DataFrame, column: str, points: int, bins: int) -> DataFrame:
    bars = histogram(df, column, bins).where(F.col("n") > 0)
    x = F.col(column).cast("double")
    stats = (
        df.select(x.alias("x"))
        .where(F.col("x").isNotNull() & ~F.isnan("x"))
        .agg(F.struct(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s"))
    )
    grid = bars.withColumn("s", stats.scalar()).select(
        ((F.col("low") + F.col("high")) / 2).alias("mid"),
        "n",
        F.col("s.n").alias("total"),
        (F.col("s.sd") * F.pow(F.col("s.n").cast("double"), F.lit(-0.2))).alias("width"),
        F.col("s.lo").alias("lo"),
        ((F.col("s.hi") - F.col("s.lo")) / (points - 1)).alias("step"),
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
    )
    at = F.col("lo") + F.col("step") * F.col("point")
    u = (at - F.col("mid")) / F.col("width")
    weight = F.exp(-0.5 * u * u) / (F.sqrt(F.lit(2.0) * F.pi()) * F.col("width"))
    return grid.groupBy("point", at.alias("x")).agg(
        (F.sum(F.col("n") * weight) / F.first("total")).alias("density")
    )


def impute_median_mode(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Fill NULLs of numeric columns with the median, of text columns with the mode.

    All medians, and all modes, come from one set of scans and are one row, whatever the number of columns.
    """
    fills: dict[str, Column] = {}
    found: list[tuple[DataFrame, str, Sequence[str], str]] = []
    if numeric:
        found.append((exact_quantiles(df, numeric, [0.5], ["median"]), "median", numeric, "double"))
    if text:
        found.append((describe_categorical(df, text), "top", text, "string"))
    for i, (table, value, columns, kind) in enumerate(found):
        row = table.agg(F.map_from_entries(F.collect_list(F.struct("column_name", value))).alias("m")).scalar()
        df = df.withColumn(f"__fill{i}", row)
        fills |= {c: F.coalesce(F.col(c).cast(kind), F.col(f"__fill{i}")[c]) for c in columns}
    return df.withColumns(fills).drop(*[f"__fill{i}" for i in range(len(found))])
