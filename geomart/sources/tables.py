"""Tables: parquet folders, the session catalog, and databases over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from geomart.operators.star import LOAD_ORDER, check_star
from geomart.session import materialize


@dataclass(frozen=True)
class FolderTables:
    """Each table is a parquet folder below ``base``."""

    spark: SparkSession
    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        try:
            self.read(name)
        except AnalysisException:
            return False
        return True

    def create_empty(self, name: str, schema: T.StructType) -> None:
        """Create the table, or replace what it holds, without rows."""
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))


@dataclass(frozen=True)
class CatalogTables:
    """Tables of the session catalog, in one database."""

    spark: SparkSession
    database: str = "default"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.database}.{name}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def create_empty(self, name: str, schema: T.StructType) -> None:
        self.spark.createDataFrame([], schema).write.mode("overwrite").saveAsTable(f"{self.database}.{name}")

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").saveAsTable(f"{self.database}.{name}")


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database; the driver jar and the credentials come from the caller."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_rows: int = 1000
    writers: int = 8

    def read(self, name: str, split: tuple[str, int, int, int] | None = None) -> DataFrame:
        """Whole table; ``split`` = (column, lowest, highest, tasks) reads it in parallel."""
        reader = self.spark.read.format("jdbc").options(url=self.url, dbtable=name, **self.properties)
        if split:
            column, low, high, tasks = split
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=tasks)
        return reader.load()

    def exists(self, name: str) -> bool:
        try:
            self.read(name)
        except PySparkException:
            return False
        return True

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, query=sql, **self.properties).load()

    def create_empty(self, name: str, schema: T.StructType) -> None:
        empty = self.spark.createDataFrame([], schema)
        self._writer(empty, name).option("truncate", True).mode("overwrite").save()

    def append(self, name: str, df: DataFrame) -> None:
        self._writer(df, name).mode("append").save()

    def _writer(self, df: DataFrame, name: str):
        return df.write.format("jdbc").options(
            url=self.url, dbtable=name, batchsize=self.batch_rows, numPartitions=self.writers, **self.properties
        )


def load_star(
    tables: Mapping[str, DataFrame], target, load_order: Sequence[str] = LOAD_ORDER, ready: Sequence[str] = ()
) -> list[str]:
    """Full refresh: empty the children first, then load the parents first.

    Every table is computed into the scratch folder and its keys are checked before the target is touched, so a
    failure or a broken key leaves the old tables in place. Tables that are not given or have no rows are
    skipped. Loading twice gives the same as once. ``ready`` names tables that already are
    plain scans of something other than the target. A target that loads all tables at once (:class:`StarStore`) does so;
    in others a failure between two tables leaves the earlier ones loaded.
    """
    if hasattr(target, "load"):
        return target.load(tables)
    staged = {n: tables[n] if n in ready else materialize(tables[n], n) for n in load_order if n in tables}
    given = [n for n, df in staged.items() if not df.isEmpty()]
    there = {n: target.read(n) for n in load_order if n not in given and target.exists(n)}
    check_star(staged | there)
    for name in reversed(given):
        target.create_empty(name, staged[name].schema)
    for name in given:
        target.append(name, staged[name])
    return given


def replace_append(df: DataFrame, target, name: str) -> DataFrame:
    """Create or replace the table without rows from the frame's schema, append, read back."""
    target.create_empty(name, df.schema)
    target.append(name, df)
    return target.read(name)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)
