"""What several text operators share: table access, words, held-out rows, even buckets."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: ASCII capitals to small letters, byte by byte; all other bytes stay.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

BUCKET_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty), under fixed names."""
    own = df[id_col] if id_col == "doc_id" else df[id_col].alias("doc_id")  # an alias that isn't needed hides equal plans
    return df.select(own, F.coalesce(df[text_col], F.lit("")).alias("text"))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode().translate(LOWER).split()  # bytes.split() cuts at exactly these bytes


def crc_of(id_col: str | Column) -> Column:
    """crc32 of the id as text (a null id counts as the empty text)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def in_buckets(texts: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Add ``bucket``: a hash of id and text modulo a number that follows the bytes of all texts.

    A bucket holds about ``bucket_bytes`` whatever the size of the table, and a pure function
    of the row gives it, so that two passes and a recomputed task agree. One document is never cut.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    return texts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.md5("text")), F.lit(n)).cast("int"))


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, after which the task gives its free memory back: Spark keeps the Python process for later
    tasks and stages, and on one executor these processes add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def arrow_schema(df: DataFrame, schema: str | StructType) -> pa.Schema:
    """Arrow form of a schema; ``df`` only makes sure that a session is at work."""
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
