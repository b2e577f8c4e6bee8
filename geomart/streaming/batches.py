"""Batches that a count or a time closes, whichever comes first, held in state between micro-batches."""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from geomart.streaming.consume import BATCH_SECONDS, CHUNK_ROWS

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BY_COUNT, BY_TIME = "count", "time"
NAMES = ("lane", "batch", "place", "closed_by")
PACKED = "batch_row"


def packed(c: Column, kind: T.DataType) -> Column:
    """A value as text (binary stays): pandas would make other numbers of integers beside NULLs, and NULLs of NaN."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return c
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: packed(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(packed(e["key"], kind.keyType).alias("key"), packed(e["value"], kind.valueType).alias("value"))
        return F.transform(F.map_entries(c), entry)
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[packed(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]))
    return c.cast("string")


def unpacked(c: Column, kind: T.DataType) -> Column:
    """What :func:`packed` was given."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return c
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c.cast("long"))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: unpacked(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(unpacked(e["key"], kind.keyType).alias("key"), unpacked(e["value"], kind.valueType).alias("value"))
        return F.map_from_entries(F.transform(c, entry))
    if isinstance(kind, T.StructType):
        fields = [unpacked(c.getField(f"f{i}"), f.dataType).alias(f.name) for i, f in enumerate(kind.fields)]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.cast(kind)


def plain(value, kind: T.DataType):
    """A packed value as pandas gives it, as the state takes it: structs as tuples, arrays as lists."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(plain(value[f.name], f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return [plain(v, kind.elementType) for v in value]
    return value


class Closer(StatefulProcessor):
    """Per lane: the rows that wait, and the number of the open batch.

    Less than a whole batch waits in state, so state is bounded by lanes times rows. The timer belongs to the
    first row that waits. Rows come and go in frames of bounded size, whatever the number of rows of a lane in a micro-batch.
    """

    def __init__(self, schema: T.StructType, rows: int, seconds: float):
        self.schema, self.rows, self.wait = schema, rows, int(seconds * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.open = handle.getValueState("open", "batch long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number = self.open.get()[0] if self.open.exists() else 0
        held = list(self.waiting.get()) if self.waiting.exists() else []
        began = len(held)
        closed = 0
        for frame in rows:
            held += [plain(row, self.schema) for row in frame[PACKED]]
            whole = len(held) // self.rows
            if whole:
                yield self.closed(key, number + closed, held[: whole * self.rows], BY_COUNT)
                held, closed = held[whole * self.rows :], closed + whole
        if closed or not self.open.exists():
            self.open.update((number + closed,))
        if held:
            self.waiting.put(held)
        else:
            self.waiting.clear()
        if closed or not began:  # another row is the first to wait now
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if held:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, held = self.open.get()[0], list(self.waiting.get())
        self.waiting.clear()
        if held:
            self.open.update((number + 1,))
            yield self.closed(key, number, held, BY_TIME)

    def closed(self, key, number: int, held: list[tuple], why: str) -> pd.DataFrame:
        """The batches from ``number`` on, of which all but the last are whole."""
        at = range(len(held))
        return pd.DataFrame(
            {
                "lane": [int(key[0])] * len(held),
                "batch": [number + i // self.rows for i in at],
                "place": [i % self.rows for i in at],
                "closed_by": [why] * len(held),
                PACKED: [tuple(row) for row in held],
            }
        )

    def close(self) -> None:
        pass


def close_batches(
    df: DataFrame, rows: int = CHUNK_ROWS, seconds: float = BATCH_SECONDS, lanes: int = 8, lane: Column | None = None
) -> DataFrame:
    """``lane, batch, place, closed_by`` and the columns of a stream: rows come out when their batch closes.

    Rows are dealt to ``lanes`` by a hash of the whole row, or by an integer ``lane`` modulo ``lanes``; a batch holds
    rows of one lane, ``rows`` at most, and no row waits longer than ``seconds`` and the time to the next
    micro-batch. ``(lane, batch)`` names a batch and ``place`` a row in it, in every run from one checkpoint.
    """
    if taken := {c.lower() for c in df.columns}.intersection({*NAMES, "batch_lane"}):
        raise ValueError(f"columns of the stream may not be called {', '.join(sorted(taken))}")
    dealt = F.pmod(lane if lane is not None else F.xxhash64(*df.columns), F.lit(lanes)).cast("long")
    rows_in = df.select(dealt.alias("batch_lane"), packed(F.struct(*df.columns), df.schema).alias(PACKED))
    kept = rows_in.schema[PACKED].dataType
    kinds = (T.LongType(), T.LongType(), T.LongType(), T.StringType())
    out = T.StructType([*[T.StructField(n, kind) for n, kind in zip(NAMES, kinds)], T.StructField(PACKED, kept)])
    closer = Closer(kept, rows, seconds)
    closed = rows_in.groupBy("batch_lane").transformWithStateInPandas(closer, out, "Append", "ProcessingTime")
    return closed.select(*NAMES, unpacked(F.col(PACKED), df.schema).alias(PACKED)).select(*NAMES, f"{PACKED}.*")


def deliver_batches(closed: DataFrame, out: str, checkpoint: str, every: float = 1.0) -> StreamingQuery:
    """Start the query; what closes in a micro-batch overwrites that micro-batch's folder below ``out``.

    Needs the RocksDB state store, which is set for this query only.
    """
    spark = closed.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        return (
            closed.writeStream.foreachBatch(
                lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/micro_batch={number}")
            )
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{int(every * 1000)} milliseconds")
            .start()
        )
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def after(query: StreamingQuery, moment: float, quiet: bool = False) -> None:
    """Wait for the end of a micro-batch that began after ``moment``; with ``quiet`` one that read no rows."""
    while query.isActive:
        p = query.lastProgress
        if p and datetime.fromisoformat(p["timestamp"]).timestamp() > moment and not (quiet and p["numInputRows"]):
            return
        time.sleep(0.05)
    if failed := query.exception():
        raise failed


def caught_up(query: StreamingQuery) -> None:
    """Wait until all that is there now has been read. (With timers there always is a next micro-batch, so
    ``processAllAvailable`` would never return.)"""
    after(query, time.time(), quiet=True)


def finish(query: StreamingQuery, seconds: float = BATCH_SECONDS) -> None:
    """Take all that is there, let the time limit close what is open, and stop.

    Every timer has fired when a micro-batch has ended that began after the limit from the last row on.
    """
    caught_up(query)
    after(query, time.time() + seconds)
    query.stop()
