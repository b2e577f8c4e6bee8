"""A topic as a folder: partitions of numbered records, and a streaming source that reads them by offset.

``<topic>/partition=<p>/<first>-<next>.parquet`` holds the records of partition ``p`` from offset ``first``
up to ``next``. Segments never change, so an offset names one record for good, and the newest offsets are
read off the file names.
"""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from geomart.streaming.records import to_records

FORMAT = "partitioned_log"
RECORD = "key string, value string, partition int, offset long, timestamp timestamp"
SEGMENT_ROWS = 100_000
FOLDER, SEGMENT = re.compile(r"partition=(\d+)$"), re.compile(r"(\d+)-(\d+)\.parquet$")
STORED = pa.schema([("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"\w+:", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass(frozen=True)
class Segment(InputPartition):
    """Records ``start`` to ``end`` of one file, whose first record is ``first``."""

    partition: int
    path: str
    first: int
    start: int
    end: int


def segments(topic: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first, next, path) of each segment by partition, in order; a topic that isn't there has none."""
    fs, root = file_system(topic)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for f in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = SEGMENT.search(f.base_name)
        folder = FOLDER.search(f.path.rsplit("/", 1)[0])
        if f.type == pafs.FileType.File and name and folder:
            found.setdefault(int(folder[1]), []).append((int(name[1]), int(name[2]), f.path))
    return {p: sorted(s) for p, s in sorted(found.items())}


def earliest(topic: str) -> dict[str, int]:
    return {str(p): s[0][0] for p, s in segments(topic).items()}


def latest(topic: str) -> dict[str, int]:
    return {str(p): s[-1][1] for p, s in segments(topic).items()}


def between(topic: str, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
    """The pieces of segments from the offsets ``start`` to ``end``; a partition new since ``start`` is read from 0 on."""
    out = []
    for p, parts in segments(topic).items():
        a, b = start.get(str(p), 0), end.get(str(p), 0)
        out += [Segment(p, path, lo, max(a, lo), min(b, hi)) for lo, hi, path in parts if lo < b and hi > a]
    return out


def read_segment(topic: str, piece: Segment) -> Iterator[pa.RecordBatch]:
    """The records of a piece; row groups outside it aren't read."""
    fs, _ = file_system(topic)
    file = pq.ParquetFile(fs.open_input_file(piece.path))
    at = piece.first
    for group in range(file.num_row_groups):
        n = file.metadata.row_group(group).num_rows
        if at < piece.end and at + n > piece.start:
            for batch in file.iter_batches(row_groups=[group]):
                lo, hi = max(piece.start - at, 0), min(piece.end - at, batch.num_rows)
                if lo < hi:
                    rows = batch.slice(lo, hi - lo)
                    places = pa.array(range(at + lo, at + hi), pa.int64())
                    partition = pa.array([piece.partition] * (hi - lo), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("key"), rows.column("value"), partition, places, rows.column("timestamp")],
                        names=["key", "value", "partition", "offset", "timestamp"],
                    )
                at += batch.num_rows
        else:
            at += n


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, topic: str, starting: str):
        self.topic, self.starting = topic, starting

    def initialOffset(self) -> dict:
        return latest(self.topic) if self.starting == "latest" else earliest(self.topic)

    def latestOffset(self) -> dict:
        return latest(self.topic)

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return between(self.topic, start, end)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return read_segment(self.topic, partition)


class LogReader(DataSourceReader):
    def __init__(self, topic: str):
        self.topic = topic

    def partitions(self) -> list[Segment]:
        return between(self.topic, {}, latest(self.topic)) or [Segment(0, "", 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return read_segment(self.topic, partition) if partition.path else iter(())


class LogSource(DataSource):
    """Options: ``path``, and ``startingOffsets`` (``earliest`` or ``latest``) for a stream without a checkpoint."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema: StructType) -> LogStreamReader:
        starting = self.options.get("startingOffsets", "earliest")
        if starting not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets: {starting}")
        return LogStreamReader(self.options["path"], starting)

    def reader(self, schema: StructType) -> LogReader:
        return LogReader(self.options["path"])


def read_log(spark: SparkSession, topic: str, starting: str = "earliest", stream: bool = True) -> DataFrame:
    """The records of a topic with partition, offset and time; a stream's checkpoint keeps its position."""
    spark.dataSource.register(LogSource)
    if not stream:
        return spark.read.format(FORMAT).load(topic)
    return spark.readStream.format(FORMAT).option("startingOffsets", starting).load(topic)


def publish_log(df: DataFrame, topic: str, key: str | None = None, partitions: int = 4, segment_rows: int = SEGMENT_ROWS) -> int:
    """Append the rows as records to a topic; the rows sent.

    Records of one key go to one partition, in the order of their values there; without a key the value decides. Tasks
    write segments aside and the driver moves them into place in order of their offsets, so a failed publication
    shows nothing and a repeated task nothing twice. One publisher at a time.
    """
    fs, root = file_system(topic)
    aside = f"{root}/.aside-{uuid.uuid4().hex}"
    first = {int(p): n for p, n in latest(topic).items()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = file_system(topic)
        writer = sink = None
        path, part, begin, at = "", None, 0, 0
        done: list[tuple[int, int, int, str]] = []

        def finish() -> None:
            if writer:
                writer.close()
                sink.close()
                done.append((part, begin, at, path))

        offsets = dict(first)
        for batch in batches:
            of = batch.column("partition").to_pylist()
            i = 0
            while i < batch.num_rows:
                if writer is None or of[i] != part or at - begin == segment_rows:
                    finish()
                    part = of[i]
                    begin = at = offsets.get(part, 0)
                    path = f"{aside}/{part}-{uuid.uuid4().hex}"
                    own.create_dir(aside, recursive=True)
                    sink = own.open_output_stream(path)
                    writer = pq.ParquetWriter(sink, STORED)
                j = i
                while j < batch.num_rows and of[j] == part and at - begin + j - i < segment_rows:
                    j += 1
                rows = batch.slice(i, j - i)
                writer.write_batch(pa.RecordBatch.from_arrays([rows.column(c).cast(STORED.field(c).type) for c in STORED.names], schema=STORED))
                at += j - i
                offsets[part] = at
                i = j
        finish()
        columns = list(zip(*done)) or [[], [], [], []]
        yield pa.RecordBatch.from_pydict(dict(zip(("partition", "begin", "next", "path"), map(list, columns))), schema=WRITTEN)

    records = to_records(df, key).withColumn("timestamp", F.current_timestamp())
    dealt = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    records = records.withColumn("partition", dealt).repartition(partitions, "partition")
    records = records.sortWithinPartitions("partition", "key", "value").select("partition", "key", "value", "timestamp")
    try:
        written = records.mapInArrow(write, "partition int, begin long, next long, path string").collect()  # a row per segment
        for r in sorted(written, key=lambda r: (r.partition, r.begin)):
            fs.create_dir(f"{root}/partition={r.partition}", recursive=True)
            fs.move(r.path, f"{root}/partition={r.partition}/{r.begin:020d}-{r.next:020d}.parquet")
    finally:
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(aside)
    return sum(r.next - r.begin for r in written)


WRITTEN = pa.schema([("partition", pa.int32()), ("begin", pa.int64()), ("next", pa.int64()), ("path", pa.string())])
