"""Schema shaping, filters and fills."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.functions.text import clean_text, to_number


def normal_name(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z_]", "", name.lower().replace(" ", "_"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names, blanks to ``_``, other signs dropped. Two equal results are an error."""
    names = [normal_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names become equal: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric``, ``string``, ``boolean`` or ``datetime`` columns."""
    kinds = {
        "numeric": T.NumericType,
        "string": T.StringType,
        "boolean": T.BooleanType,
        "datetime": T.DatetimeType,
    }
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def keep_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Negated membership; a NULL is not in the list, so its row stays."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which ``condition`` is true; false and NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def parse_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to numbers: long when every value present is whole, else double.

    The choice needs the data: one pass over all the columns together.
    """
    numbers = {c: to_number(F.col(c)) for c in columns}
    parsed = df.withColumns(numbers)
    test = [F.coalesce(F.bool_and(F.col(c) == F.floor(c)), F.lit(True)).alias(c) for c in columns]
    whole = parsed.select(*columns).agg(*test).first().asDict() if columns else {}
    fits = lambda c: F.when(F.col(c) == F.floor(c), F.col(c)).try_cast("long")
    return parsed.withColumns({c: fits(c) for c in columns if whole[c]})


def clean_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c)) for c in columns if c in df.columns})


def parse_observed(df: DataFrame, parsed: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Replace columns by their parsed form and count the NULLs this makes on the way.

    The counts are in the observation once the frame has been written or counted, without
    a pass of their own.
    """
    made = Observation()
    fresh = {f"__{name}": expr for name, expr in parsed.items()}
    counts = [F.count_if(F.col(n).isNotNull() & F.col(f"__{n}").isNull()).alias(n) for n in parsed]
    watched = df.withColumns(fresh).observe(made, *counts)
    return watched.withColumns({n: F.col(f"__{n}") for n in parsed}).drop(*fresh), made


def coercion_report(raw: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per column: NULLs before, NULLs after and NULLs made by parsing. One pass."""
    stats = []
    for name, expr in parsed.items():
        before = F.count_if(F.col(name).isNull())
        after = F.count_if(expr.isNull())
        stats.append(
            F.struct(
                F.lit(name).alias("column_name"),
                before.alias("nulls_before"),
                after.alias("nulls_after"),
                (after - before).alias("coerced"),
            )
        )
    return raw.agg(F.array(*stats).alias("s")).select(F.inline("s"))
