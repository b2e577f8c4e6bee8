"""Token ids of a corpus in files of compressed blocks, in ascending order of the documents.

A shard holds a range of documents: blocks of ``BLOCK_IDS`` ids coded by :mod:`rangecoder`, each
with its number of ids, size and checksum and none depending on another, then the list of
documents with their numbers of ids, and a foot that says where that list begins. Tasks write
shards to the shared folder and report them; only reported shards are read. The first id of a shard in the
whole corpus is the sum of the shards before it.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, BUCKET_BYTES, LOWER, released, texts_of
from geomart.llm.rangecoder import decode_blocks, encode_blocks
from geomart.llm.warc import open_fs
from geomart.session import scratch_path

MAGIC = b"GMTOKEN2"
BLOCK_IDS = 1024
GROUP_BLOCKS = 10_000  # coded side by side; with a power of 2 the arrays' rows would share cache sets
BLOCK_HEAD = struct.Struct("<III")  # ids, bytes, crc32 of the ids as little-endian u32
FOOT = struct.Struct("<QQQ8s")  # place of the document list, documents, ids
END_ID = 2
CACHE_WORDS = 1_500_000
SHARD_BYTES = 24 << 20  # the more blocks advance together, the less an id costs
SLICE_BYTES = 20_000_000
CALL_PARTS = 500

BAR = "|"
MARKS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"  # without those in names of special tokens
LETTERS = "A-Za-zß-öø-ÿ"
PLAIN = f"^(?:[{LETTERS}]+|[{re.escape(MARKS)}]+)$"
LETTER_LAST = f"[0-9{LETTERS}]$"
#: Byte-level vocabularies show a byte as the letter of its number, but for these among the bytes of ``LETTERS``.
SHOWN = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}

SHARD = "path string, range int, ids long"
ROW = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Pool:
    """Strings and their ids, all in one array; strings go by their place."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.ids, self.begin, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def places(self, strings: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, ...]]) -> np.ndarray:
        """Place of each string. ``encode`` gets the new ones and gives their order, their ids in it, and the numbers of ids."""
        coded = strings.dictionary_encode()
        found = pc.index_in(coded.dictionary, self.names)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        if found.null_count:
            order, ids, count = encode(coded.dictionary.filter(found.is_null()))
            new = np.flatnonzero(at < 0)[order]
            at[new] = len(self.names) + np.arange(len(new))
            ends = len(self.ids) + np.cumsum(count, dtype=np.int32)
            self.names = pa.concat_arrays([self.names, coded.dictionary.take(pa.array(new))])
            self.ids = np.concatenate((self.ids, ids))
            self.begin = np.concatenate((self.begin, ends - count.astype(np.int32)))
            self.count = np.concatenate((self.count, count.astype(np.int32)))
        return at[coded.indices.to_numpy()]

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these strings, one string after the other, and their numbers of ids."""
        count = self.count[places]
        before = np.cumsum(count, dtype=np.int32) - count
        at = np.repeat(self.begin[places] - before, count)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at], count


class Words:
    """Ids of whole texts by the ids of their words.

    The tokenizer's own rules cut at white space, and between a letter or digit and the marks after it; so
    the ids of a text are those of the parts, and each distinct part is encoded once. Its rules take a part all of
    Latin letters or all of marks as it is; such parts go straight to its model, many in a call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a part
        self.is_last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.bar = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        # the names of special tokens stand for their ids, but only as they are written
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.words, self.parts = Pool(), Pool()

    def lowered(self, texts: pa.Array) -> pa.Array:
        """Only texts all of ASCII are lower-cased beforehand: with other letters the order of lower-casing and
        composing could matter. Nor is a text in which the name of a special token would come up by it."""
        low = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
        for s in self.special:
            low = pc.if_else(pc.match_substring(low, s), texts, low)
        return low

    def together(self, tokenizer, parts: list[str], between: str) -> np.ndarray:
        """Ids of all parts, each with ``between`` behind it."""
        joined = [between.join(parts[i : i + CALL_PARTS]) + between for i in range(0, len(parts), CALL_PARTS)]
        if tokenizer is self.model:  # whose vocabulary shows bytes as letters
            joined = [j.encode().translate(LOWER).decode("latin-1") for j in joined]
            for byte, letter in SHOWN.items():
                joined = [j.replace(byte, letter) for j in joined]
        return np.concatenate([np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)])

    def encode_plain(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.together(self.model, parts, " ")
        ends = np.flatnonzero(self.is_last[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(parts) else self.encode_other(parts)

    def encode_other(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.together(self.tokenizer, parts, f" {BAR} ")
        bars = np.flatnonzero(ids == self.bar[0])
        whole = len(self.bar) == 1 and len(bars) == len(parts)
        return (np.delete(ids, bars), np.diff(bars, prepend=-1) - 1) if whole else self.encode_apart(parts)

    def encode_apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(each)), "<u4"), np.array([len(ids) for ids in each])

    def encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, ...]:
        plain = pc.match_substring_regex(parts, PLAIN).to_numpy(zero_copy_only=False)
        bar = pc.match_substring(parts, BAR).to_numpy(zero_copy_only=False)
        order, ids, counts = [], [], []
        for kind, encode in ((plain, self.encode_plain), (~plain & ~bar, self.encode_other), (bar, self.encode_apart)):
            if kind.any():
                order.append(np.flatnonzero(kind))
                some, count = encode(parts.filter(pa.array(kind)).to_numpy(zero_copy_only=False).tolist())
                ids.append(some)
                counts.append(count)
        return np.concatenate(order), np.concatenate(ids), np.concatenate(counts)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        core = pc.ascii_rtrim(words, characters=MARKS)
        marked = pc.and_(pc.not_equal(core, words), pc.match_substring_regex(core, LETTER_LAST))
        core = pc.if_else(marked, core, words)
        pairs = (a.filter(marked).to_numpy(zero_copy_only=False).tolist() for a in (words, core))
        tails = [w[len(c) :] for w, c in zip(*pairs)]
        at = self.parts.places(pa.concat_arrays([core, pa.array(["", *tails], pa.string())]), self.encode_parts)
        own = np.full((len(words), 2), at[len(words)])
        own[:, 0] = at[: len(words)]
        own[marked.to_numpy(zero_copy_only=False), 1] = at[len(words) + 1 :]
        ids, count = self.parts.ids_at(own.ravel())
        return np.arange(len(words)), ids, count.reshape(-1, 2).sum(1)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and the number of ids of each."""
        if len(self.words.names) > CACHE_WORDS:
            self.forget()
        units = pc.ascii_split_whitespace(self.lowered(texts))
        ids, count = self.words.ids_at(self.words.places(units.flatten(), self.encode_words))
        ends = np.concatenate(([0], np.cumsum(count)))
        return ids, np.diff(ends[units.offsets.to_numpy()])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian u32."""
        ids, count = self.encode_all(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(count)[:-1])]


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """One per Python worker, so that the tasks of a worker share what they know."""
    return Words(path)


class Writer:
    """Writes one shard; holds the ids of one group of blocks at most, and the list of documents."""

    def __init__(self, sink):
        self.sink, self.at, self.buffer, self.size, self.total = sink, 0, [], 0, 0
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.put(MAGIC)

    def put(self, raw: bytes) -> None:
        self.sink.write(raw)
        self.at += len(raw)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.add_all([doc_id], ids, [len(ids)])

    def add_all(self, doc_ids: list[int | None], ids: np.ndarray, counts: list[int]) -> None:
        """Documents whose ids stand one after the other."""
        self.docs += doc_ids
        self.counts += counts
        self.total += len(ids)
        self.buffer.append(ids)
        self.size += len(ids)
        if self.size >= GROUP_BLOCKS * BLOCK_IDS:
            self.flush(False)

    def flush(self, all_: bool) -> None:
        """Write the whole blocks at hand, and the rest too at the end."""
        ids = np.concatenate(self.buffer) if self.buffer else np.zeros(0, "<u4")
        while len(ids) >= GROUP_BLOCKS * BLOCK_IDS or (all_ and len(ids)):
            part, ids = ids[: GROUP_BLOCKS * BLOCK_IDS], ids[GROUP_BLOCKS * BLOCK_IDS :]
            for i, payload in enumerate(encode_blocks(part, BLOCK_IDS)):
                own = part[i * BLOCK_IDS : (i + 1) * BLOCK_IDS]
                self.put(BLOCK_HEAD.pack(len(own), len(payload), zlib.crc32(own.tobytes())) + payload)
        self.buffer, self.size = [ids], len(ids)

    def close(self) -> None:
        self.flush(True)
        place = self.at
        null = np.array([d is None for d in self.docs], "u1")
        self.put(np.array([0 if d is None else d for d in self.docs], "<i8").tobytes() + null.tobytes())
        self.put(np.array(self.counts, "<u8").tobytes())
        self.put(FOOT.pack(place, len(self.docs), self.total, MAGIC))


class BadShard(ValueError):
    """A shard that is cut short or fails a checksum."""


def read_shard(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """``(document, ids)`` from a shard, group of blocks by group; every block's checksum is verified."""
    size = source.size()
    source.seek(size - FOOT.size)
    place, n_docs, total, magic = FOOT.unpack(source.read(FOOT.size))
    if magic != MAGIC:
        raise BadShard("no foot")
    source.seek(place)
    docs = np.frombuffer(source.read(8 * n_docs), "<i8").tolist()
    null = source.read(n_docs)
    counts = np.frombuffer(source.read(8 * n_docs), "<u8").astype(np.int64).tolist()
    source.seek(0)
    if source.read(len(MAGIC)) != MAGIC:
        raise BadShard("no head")

    def groups() -> Iterator[np.ndarray]:
        at = len(MAGIC)
        while at < place:
            heads, payloads = [], []
            while at < place and len(heads) < GROUP_BLOCKS:
                heads.append(BLOCK_HEAD.unpack(source.read(BLOCK_HEAD.size)))
                payloads.append(source.read(heads[-1][1]))
                at += BLOCK_HEAD.size + heads[-1][1]
            ids = decode_blocks(payloads, [h[0] for h in heads]).astype("<u4")
            for i, h in enumerate(heads):
                if zlib.crc32(ids[i * BLOCK_IDS : i * BLOCK_IDS + h[0]].tobytes()) != h[2]:
                    raise BadShard(f"checksum of block {i}")
            yield ids

    more, rest, seen = groups(), np.zeros(0, "<u4"), 0
    for doc, is_null, n in zip(docs, null, counts):
        while len(rest) < n:
            try:
                rest = np.concatenate((rest, next(more)))
            except StopIteration:
                raise BadShard("too few ids") from None
        yield (None if is_null else doc), rest[:n]
        rest, seen = rest[n:], seen + n
    if seen != total:
        raise BadShard("another number of ids")


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> list[tuple[str, int]]:
    """Encode and write all documents; path and first id of each shard, in order."""
    texts = texts_of(docs)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    target = arrow_schema(docs, SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, sink = words(tokenizer_path), None, None
        path = f"{folder}/{uuid.uuid4().hex}.tok"
        for b in batches:
            doc_ids, texts = b.column("doc_id").to_pylist(), b.column("text")
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            begin = 0
            while begin < len(doc_ids):
                before = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
                ids, counts = encoder.encode_all(texts.slice(begin, stop - begin))
                if writer is None:
                    fs, at = open_fs(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(at, compression=None)
                    writer = Writer(sink)
                writer.add_all(doc_ids[begin:stop], np.insert(ids, np.cumsum(counts), end_id), (counts + 1).tolist())
                begin = stop
        if writer is not None:
            writer.close()
            sink.close()
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"path": [path], "range": [number], "ids": [writer.total]}, schema=target)

    # A hash of the text spreads rows without an id, or with one that many repeat; tasks are numbered in the order of their ranges.
    tied = texts.withColumn("tie", F.xxhash64("text"))
    sorted_ = tied.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    written = sorted_.mapInArrow(released(run), SHARD).collect()  # one row per shard
    written.sort(key=lambda r: r.range)
    starts = np.cumsum([0] + [r.ids for r in written]).tolist()
    return [(r.path, s) for r, s in zip(written, starts)]


def read(spark: SparkSession, shards: list[tuple[str, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    listed = spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(shards)], "i int, path string, start long")
    listed = listed.repartition(max(1, len(shards)), "i").select("path", "start")
    target = arrow_schema(listed, ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, at = open_fs(path)
                out: dict[str, list] = {c: [] for c in target.names}
                with fs.open_input_file(at) as source:
                    for doc_id, ids in read_shard(source):
                        for c, v in zip(target.names, (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))):
                            out[c].append(v)
                        start += len(ids)
                yield pa.RecordBatch.from_pydict(out, schema=target)

    return listed.mapInArrow(released(run), ROW)


def round_trip(docs: DataFrame, tokenizer_path: str, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the ids of all documents and return what reading the files gives.

    A null text is empty and has only its end id; documents without id come first; rows
    that repeat an id are in the order of a hash of their texts; an empty table gives no file and no rows; further
    columns are not read; a document of any length may span blocks and groups.
    """
    spark = docs.sparkSession
    return read(spark, write(docs, tokenizer_path, folder or scratch_path(spark, "tokens"), shard_bytes=shard_bytes))
