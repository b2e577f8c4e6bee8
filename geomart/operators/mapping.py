"""Value mapping: ordered category groups and fuzzy standardisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.functions.fuzzy import SCORERS
from geomart.session import materialize

# The groups in their order of precedence, and the group of all other values.
CATEGORY_GROUPS = (
    "cultural",
    "restaurants",
    "parks_&_outdoor",
    "retail_&_shopping",
    "entertainment_&_leisure",
    "landmarks",
    "bars_&_clubs",
)
OTHER_GROUP = "Other"


def category_map(
    df: DataFrame, column: str, out: str, groups: Mapping[str, Sequence[str]], other: str = OTHER_GROUP
) -> DataFrame:
    """Add the first group (in the order of ``groups``) that lists the value, else ``other``.

    The lists are an argument: they are reference data of the user, not of the library.
    Each group becomes one set test in a single expression, so no join is needed.
    """
    first: dict[str, str] = {}
    for group, values in groups.items():
        for value in values:
            first.setdefault(value, group)
    if not first:
        return df.withColumn(out, F.lit(other))
    by_group: dict[str, list[str]] = {}
    for value, group in first.items():
        by_group.setdefault(group, []).append(value)
    chain = F
    for group, values in by_group.items():
        chain = chain.when(F.col(column).isin(*values), F.lit(group))
    return df.withColumn(out, chain.otherwise(F.lit(other)))


def category_map_by_table(
    df: DataFrame, column: str, out: str, table: DataFrame, group: str, value: str, priority: str, other: str = OTHER_GROUP
) -> DataFrame:
    """As :func:`category_map`, with the lists as a table of any size: the group of least ``priority`` wins."""
    first = table.where(F.col(value).isNotNull()).groupBy(F.col(value).alias(column))
    first = first.agg(F.min(F.struct(priority, F.col(group).alias("g")))["g"].alias("__group"))
    joined = df.join(first, column, "left")
    columns = [c for c in df.columns if c != out]
    return joined.select(*columns, F.coalesce("__group", F.lit(other)).alias(out))


def best_matches(values: DataFrame, column: str, choices: Sequence[str], scorer: str) -> DataFrame:
    """(column, match, score): the best choice of each row; the earlier choice wins a tie.

    Every value meets every choice, so ``choices`` is meant to be a short list.
    """
    options = F.posexplode(F.array(*[F.lit(c) for c in choices])).alias("place", "choice")
    scored = values.select(column, options).withColumn("score", SCORERS[scorer](F.col(column), F.col("choice")))
    best = F.max(F.struct("score", (-F.col("place")).alias("first"), "choice"))
    return scored.groupBy(column).agg(best.alias("b")).select(
        column, F.col("b.choice").alias("match"), F.col("b.score").alias("score")
    )


def fuzzy_standardize(
    df: DataFrame,
    column: str,
    choices: Sequence[str],
    cutoff: float | None = 85,
    scorer: str = "weighted",
    out: str | None = None,
) -> DataFrame:
    """Replace each value by its best choice when the score reaches ``cutoff``, else keep it.

    Only distinct values are scored; the result is written and joined back, so that the planner knows its size: few
    values are broadcast, and the rows aren't shuffled by a column that may hold a handful of values. ``cutoff=None`` always
    takes the best choice. NULL stays NULL.
    """
    out = out or column
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    matched = best_matches(distinct, column, choices, scorer)
    if cutoff is not None:
        matched = matched.where(F.col("score") >= cutoff)
    matched = materialize(matched.select(column, F.col("match").alias("__match")), "matches")
    joined = df.join(matched, column, "left")
    order = [c for c in df.columns if c != out] if out != column else df.columns
    return joined.withColumn(out, F.coalesce("__match", column)).select(*order, *([] if out in order else [out]))


def changed_count(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.agg(F.count_if(~F.col(old).eqNullSafe(F.col(new))).alias("changed"))
