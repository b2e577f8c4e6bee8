"""Ids that were collected already, kept in buckets so that a new batch meets them without moving them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomart.operators.skew import first_per_key


@dataclass(frozen=True)
class SeenIds:
    """A catalog table of ids, bucketed by id.

    Joined with a batch, only the batch is shuffled, into the buckets of the table: the cost of a batch is its own rows and
    one local read of the ids, however long the history is. ``buckets`` is fixed when the table is
    made; take it so that a bucket of the history fits a task (and not below ``spark.sql.shuffle.partitions``,
    or the planner would rather shuffle both sides). Many small batches make many small files; :meth:`compact` joins them.
    """

    spark: SparkSession
    table: str
    key: str
    buckets: int = 64

    def create(self, like: DataFrame, path: str | None = None) -> SeenIds:
        """Make the table without rows, with the type of ``like``'s key, unless it is there."""
        if not self.spark.catalog.tableExists(self.table):
            self._writer(like.select(self.key).limit(0), path).saveAsTable(self.table)
        return self

    def _writer(self, ids: DataFrame, path: str | None = None):
        writer = ids.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        return writer.option("path", path) if path else writer

    def ids(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def fresh(self, batch: DataFrame, order_by: list[str | Column]) -> DataFrame:
        """The rows of ``batch`` whose id is present and not yet seen; the first row per id in ``order_by``."""
        known = self.ids().select(F.col(self.key).alias("__seen"))
        rows = first_per_key(batch.where(F.col(self.key).isNotNull()), [self.key], order_by)
        return rows.join(known.hint("merge"), F.col(self.key) == F.col("__seen"), "left_anti")

    def add(self, rows: DataFrame) -> None:
        """Note the ids of ``rows`` as seen, once what belongs to them is safely written.

        Adding an id twice changes no result. One task per bucket writes, so a batch makes one file a bucket at most.
        """
        ids = rows.select(self.key).where(F.col(self.key).isNotNull()).repartition(self.buckets, self.key)
        ids.write.insertInto(self.table)

    def compact(self, path: str | None = None) -> SeenIds:
        """A new table of the same ids, each once, one sorted file a bucket; the old one stays until it is dropped."""
        name = f"{self.table}_compact"
        made = SeenIds(self.spark, name, self.key, self.buckets)
        made._writer(self.ids().distinct(), path).saveAsTable(name)
        return made
