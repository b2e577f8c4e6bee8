"""Data-quality suites: one aggregation per suite, row-level reports, and a gate."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomart.operators.mapping import CATEGORY_GROUPS, OTHER_GROUP

EXISTS = "expect_column_to_exist"
BETWEEN = "expect_column_values_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"


class QualityError(Exception):
    """A gate found failed expectations."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = ()

    @property
    def label(self) -> str:
        return f"{self.kind}:{self.column}"

    def unexpected(self) -> Column:
        """True for a value that breaks the rule; a missing value breaks only NOT_NULL."""
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == IN_SET:
            return F.coalesce(~c.isin(*self.value_set), F.lit(False))
        if self.kind == BETWEEN:
            bad = F.lit(False)
            if self.min_value is not None:
                bad = bad | (c < self.min_value)
            if self.max_value is not None:
                bad = bad | (c > self.max_value)
            return F.coalesce(bad, F.lit(False))
        return F.lit(False)


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: tuple[Expectation, ...] = field(default_factory=tuple)

    @staticmethod
    def from_json(text: str) -> Suite:
        """Read the JSON form: a suite name and a list of type + keyword arguments."""
        data = json.loads(text)
        items = []
        for e in data["expectations"]:
            args = e["kwargs"]
            items.append(
                Expectation(
                    e["expectation_type"],
                    args["column"],
                    args.get("min_value"),
                    args.get("max_value"),
                    tuple(args.get("value_set", ())),
                )
            )
        return Suite(data["expectation_suite_name"], tuple(items))

    @staticmethod
    def load(path: str) -> Suite:
        return Suite.from_json(Path(path).read_text(encoding="utf-8"))

    def save(self, path: str) -> None:
        """Create the suite file or replace it."""
        Path(path).write_text(self.to_json(), encoding="utf-8")

    def to_json(self) -> str:
        items = []
        for e in self.expectations:
            args: dict = {"column": e.column}
            if e.kind == BETWEEN:
                args |= {"min_value": e.min_value, "max_value": e.max_value}
            if e.kind == IN_SET:
                args["value_set"] = list(e.value_set)
            items.append({"expectation_type": e.kind, "kwargs": args})
        return json.dumps({"expectation_suite_name": self.name, "expectations": items}, indent=2)


# The two suites of the mart.
LISTINGS_SUITE = Suite(
    "cleaned_listings",
    (
        Expectation(BETWEEN, "lat", -90, 90),
        Expectation(BETWEEN, "long", -180, 180),
        Expectation(NOT_NULL, "neighbourhood_group"),
        Expectation(IN_SET, "room_type", value_set=("Private room", "Entire home/apt", "Shared room", "Hotel room")),
        Expectation(BETWEEN, "review_rate_number", 0, 5),
        Expectation(BETWEEN, "price", 10, 10000),
    ),
)
PLACES_SUITE = Suite(
    "cleaned_places",
    (
        Expectation(EXISTS, "latitude"),
        Expectation(EXISTS, "longitude"),
        Expectation(BETWEEN, "latitude", -90, 90),
        Expectation(BETWEEN, "longitude", -180, 180),
        Expectation(NOT_NULL, "category_group"),
        Expectation(
            IN_SET,
            "category_group",
            value_set=(*CATEGORY_GROUPS, OTHER_GROUP),
        ),
    ),
)


def validate(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per expectation; the data is read once for the whole suite.

    A check on a column that is not there fails without counts.
    """
    results = []
    for i, e in enumerate(suite.expectations):
        present = e.column in df.columns
        counted = present and e.kind != EXISTS
        nothing = F.lit(None).cast("long")
        rows = F.count(F.lit(1)) if counted else nothing
        nulls = F.count_if(F.col(e.column).isNull()) if counted else nothing
        bad = F.count_if(e.unexpected()) if counted else nothing
        base = rows if e.kind == NOT_NULL else rows - nulls
        results.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column_name"),
                rows.alias("element_count"),
                nulls.alias("null_count"),
                bad.alias("unexpected_count"),
                F.try_divide(bad * 100.0, base).alias("unexpected_percent"),
                (F.lit(present) if not counted else bad == 0).alias("success"),
            )
        )
    return df.agg(F.array(*results).alias("r")).select(F.inline("r"))


def with_failures(df: DataFrame, suite: Suite, out: str = "failed_checks") -> DataFrame:
    """Add the array of labels of the checks each row fails."""
    checks = [e for e in suite.expectations if e.kind != EXISTS and e.column in df.columns]
    failed = F.array(*[F.when(e.unexpected(), F.lit(e.label)) for e in checks])
    return df.withColumn(out, F.array_compact(failed) if checks else F.array().cast("array<string>"))


def violations(df: DataFrame, suite: Suite) -> DataFrame:
    return with_failures(df, suite).where(F.size("failed_checks") > 0)


def require_suite_columns(columns: Sequence[str], suite: Suite) -> None:
    """Refuse a table that lacks a column of the suite: no row of it could be told to pass."""
    absent = sorted({e.column for e in suite.expectations}.difference(columns))
    if absent:
        raise QualityError(f"{suite.name}: no column {', '.join(absent)}")


def split(df: DataFrame, suite: Suite) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every check, rows that fail one, with the labels); all columns of the suite must be there."""
    require_suite_columns(df.columns, suite)
    marked = with_failures(df, suite)
    return marked.where(F.size("failed_checks") == 0).drop("failed_checks"), marked.where(F.size("failed_checks") > 0)


def gate(df: DataFrame, suite: Suite) -> DataFrame:
    """Return ``df`` when the suite passes, else raise with the failed checks."""
    failed = [f"{r.expectation}({r.column_name})" for r in validate(df, suite).where(~F.col("success")).collect()]
    if failed:
        raise QualityError(f"{suite.name}: {', '.join(failed)}")
    return df


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child values without a parent row, with their row count; counted before the join."""
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(column))
    return used.join(known, column, "left_anti")


def broken_keys(
    tables: Mapping[str, DataFrame], primary: Mapping[str, str], foreign: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """``constraint, example, n``: one row per constraint that does not hold, with one key and the rows it breaks.

    ``primary`` names the key of each table, ``foreign`` holds (child, column, parent). Every table is read once:
    all its key columns are counted by value in one shuffle, with partial counts before it, and the counted keys of
    children meet those of their parents in one join. Constraints whose parent isn't given are left out.
    """
    foreign = [f for f in foreign if f[2] in primary]
    columns: dict[str, list[tuple[str, str]]] = {n: [(f"{n}.{k}", k)] for n, k in primary.items()}
    for child, column, _ in foreign:
        columns.setdefault(child, []).append((f"{child}.{column}", column))
    parent_of = {f"{child}.{column}": f"{parent}.{primary[parent]}" for child, column, parent in foreign}
    uses = None
    for name, keys in columns.items():
        pairs = F.array(*[F.struct(F.lit(label).alias("label"), F.col(c).cast("string").alias("value")) for label, c in keys])
        part = tables[name].select(F.inline(pairs))
        uses = part if uses is None else uses.unionByName(part)
    counted = uses.groupBy("label", "value").agg(F.count(F.lit(1)).alias("n"))
    own = F.col("label").isin([f"{n}.{k}" for n, k in primary.items()])
    kind = F.when(F.col("value").isNull(), "is missing").when(own & (F.col("n") > 1), "comes twice")
    alone = counted.select("label", "value", "n", kind.alias("kind")).where("kind IS NOT NULL")
    if parent_of:
        known = counted.where(own).select(F.col("label").alias("parent"), F.col("value").alias("key"))
        children = counted.where(F.col("label").isin(list(parent_of)) & F.col("value").isNotNull())
        links = F.create_map(*[F.lit(x) for pair in parent_of.items() for x in pair])
        match = (F.col("up") == F.col("parent")) & (F.col("value") == F.col("key"))
        lost = children.withColumn("up", links[F.col("label")]).join(known, match, "left_anti")
        alone = alone.unionByName(lost.select("label", "value", "n", F.lit("has no member").alias("kind")))
    return alone.groupBy(F.concat_ws(" ", "label", "kind").alias("constraint")).agg(
        F.min("value").alias("example"), F.sum("n").alias("n")
    )
