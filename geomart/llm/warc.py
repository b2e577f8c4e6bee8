"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Each task writes one archive below the shared folder and reports its path; only reported
archives are read, so what a lost or repeated task leaves behind is never seen. The reader
takes compressed blocks as they come, inflates one member after the other, frames each
record by its content length and checks its digests. Memory is one record.
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, released
from geomart.session import materialize, scratch_path

#: Equal payloads of fewer bytes are stored again and again instead of referred to.
REVISIT_BYTES = 100
BLOCK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def safe(value: str) -> str:
    """A header value without line ends or other controls."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: urllib.parse.quote(m[0]), value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record; ``first`` is the page that a revisit refers to."""
    kind = "response" if first is None else "revisit"
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (payload if first is None else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(),
        "WARC-Payload-Digest": "sha256:" + digest,
        "X-Payload-Bytes": str(len(payload)),
        "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = safe(url)
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if first is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(first), "X-Refers-To-Page-Id": str(first)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 4) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


class BadRecord(ValueError):
    """A record that isn't framed as it says, or whose digest is another."""


def members(stream) -> Iterator[bytes]:
    """Each gzip member of a stream, inflated block by block."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            block = rest or stream.read(BLOCK)
            rest = b""
            if not block:
                if parts or unpack.unconsumed_tail:
                    raise BadRecord("the archive ends within a member")
                return
            parts.append(unpack.decompress(block))
        rest = unpack.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, with framing and digests verified."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise BadRecord("no WARC header")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    size = int(headers["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise BadRecord(f"{headers['WARC-Record-ID']}: not framed by its content length")
    if "sha256:" + hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"]:
        raise BadRecord(f"{headers['WARC-Record-ID']}: block digest")
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != int(headers["X-Payload-Bytes"]):
            raise BadRecord(f"{headers['WARC-Record-ID']}: payload length")
        if "sha256:" + hashlib.sha256(payload).hexdigest() != headers["WARC-Payload-Digest"]:
            raise BadRecord(f"{headers['WARC-Record-ID']}: payload digest")
    return headers, block


def typed(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, digest, first``: ``first`` is set on revisits, to the page referred to.

    Only digests and ids are grouped. Where few payloads recur, Spark broadcasts their list by
    its written size; else it joins by digest and splits a frequent one.
    """
    rows = pages.select(
        pages["page_id"].alias("page_id"), pages["url"].alias("url"), F.coalesce(pages["html"], F.lit("")).alias("html")
    ).withColumn("digest", F.sha2(F.col("html"), 256))
    again = (
        rows.where(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("smallest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "smallest")
    )
    again = materialize(again, "payloads-again")
    joined = rows.join(again, "digest", "left")
    return joined.select("page_id", "url", "html", "digest", F.expr("nullif(smallest, page_id)").alias("first"))


def write(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> list[str]:
    """Write every page as a record; the paths of the archives."""
    open_fs(folder)[0].create_dir(open_fs(folder)[1], recursive=True)
    schema = "path string, records long"
    target = arrow_schema(pages, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sink, path = 0, None, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        try:
            for b in batches:
                for page_id, url, html, digest, first in zip(*[c.to_pylist() for c in b.columns]):
                    if sink is None:
                        fs, at = open_fs(path)
                        fs.create_dir(at.rpartition("/")[0], recursive=True)
                        sink = fs.open_output_stream(at, compression=None)
                    sink.write(member(record(page_id, url, html.encode(), digest, first)))
                    n += 1
        finally:
            if sink is not None:
                sink.close()
        if n:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, schema=target)

    return [r.path for r in typed(pages, least).mapInArrow(released(run), schema).collect()]  # one row per archive


def read(spark, paths: list[str]) -> DataFrame:
    """The records of archives, each read from its start to its end in one task, verified."""
    listed = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, path string")
    listed = listed.repartition(max(1, len(paths)), "i").select("path")
    target = arrow_schema(listed, RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = open_fs(path)
                rows: list[tuple] = []
                with fs.open_input_stream(at, compression=None) as stream:
                    for raw in members(stream):
                        h, _ = parse(raw)
                        own, first = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                        rows.append(
                            (
                                int(own) if own is not None else None,
                                h.get("WARC-Target-URI"),
                                int(h["X-Payload-Bytes"]),
                                h["WARC-Payload-Digest"].removeprefix("sha256:"),
                                h["WARC-Type"],
                                int(first) if first is not None else None,
                            )
                        )
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pydict(dict(zip(target.names, zip(*rows))), schema=target)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(target.names, map(list, zip(*rows)))), schema=target)

    return listed.mapInArrow(released(run), RECORD)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives and return what reading them gives: the columns of ``RECORD``.

    A null html is an empty payload; a null url has no target line; a page without id is never
    referred to, and a revisit if a page with an id has its payload. Rows that repeat the
    smallest id of a payload are all responses; an empty table gives no archive and no rows; further
    columns are not read. Control signs and spaces in a url are percent-encoded.
    """
    spark = pages.sparkSession
    return read(spark, write(pages, folder or scratch_path(spark, "warc")))
