"""Benchmark decontamination with suffix arrays over the training texts.

Each batch of documents is a shard: its words become numbers, the suffixes that can begin a
match are sorted by their first ``window`` words (the shard's suffix array), and every suffix
of every test item is looked up in it by binary search. A range of the array is the set of
places where the window occurs. Shards are independent, so documents are never shuffled and a
passage that a third of all documents share costs only its own hits.

Test items are searched in blocks of at most ``BLOCK_BYTES`` of text; a pass over a block adds its
hits to the rows of the pass before it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from geomart.llm.common import arrow_schema, LOWER, released
from geomart.session import materialize

WINDOW = 13
BLOCK_BYTES = 4 << 20
SLICE_CHARS = 3_000_000

#: Bytes outside words become spaces: all of ASCII but digits and letters.
WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in LOWER)

#: One verbatim match: test item's place in its block list, first word in the item, first word in the document, words.
MATCH = np.dtype([("item", "<i8"), ("item_at", "<i4"), ("doc_at", "<i4"), ("words", "<i4")])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORDS).split()


class TestSuffixes:
    """All windows of a block of test items, ready to be searched for."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        long_rows, self.short = [], []  # windows of full length; whole items of fewer words
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if len(ids) >= window:
                long_rows += [(item, at, ids[at : at + window]) for at in range(len(ids) - window + 1)]
            elif ids:
                self.short.append((item, ids))
        self.long_item = np.array([r[0] for r in long_rows], "<i8")
        self.long_at = np.array([r[1] for r in long_rows], "<i4")
        self.long_keys = self._keys([r[2] for r in long_rows])
        least = min([window if long_rows else window] + [len(ids) for _, ids in self.short])
        self.head = min(2, least)
        heads = [r[2][: self.head] for r in long_rows] + [ids[: self.head] for _, ids in self.short]
        self.heads = np.unique(np.array([self._head(h) for h in heads], np.int64))

    def _head(self, ids: list[int]) -> int:
        return ids[0] if self.head == 1 else ids[0] << 31 | ids[1]

    def _keys(self, rows: list[list[int]]) -> np.ndarray:
        """Word numbers as big-endian bytes, so that byte order is word order."""
        flat = np.array(rows, ">u4").reshape(len(rows), self.window)
        return np.frombuffer(flat.tobytes(), f"S{4 * self.window}")

    def find(self, ids: np.ndarray) -> list[tuple[int, np.ndarray, int, np.ndarray, int]]:
        """Occurrences in a shard's word numbers (0: a word of no item, or a border)."""
        if not len(self.heads):
            return []
        padded = np.concatenate((ids, np.zeros(self.window, ids.dtype)))
        n = len(ids)
        head = padded[:n].astype(np.int64)
        if self.head == 2:
            head = head << 31 | padded[1 : n + 1]
        at = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
        starts = np.flatnonzero(self.heads[at] == head)  # no other suffix can begin a match
        rows = padded[starts[:, None] + np.arange(self.window)].astype(">u4")
        keys = np.frombuffer(np.ascontiguousarray(rows).tobytes(), f"S{4 * self.window}")
        order = np.argsort(keys, kind="stable")
        array, keys = starts[order], keys[order]  # the suffix array and its sorted prefixes
        out = []
        if len(self.long_item):
            low = np.searchsorted(keys, self.long_keys, "left")
            high = np.searchsorted(keys, self.long_keys, "right")
            count = high - low
            which = np.repeat(np.arange(len(low)), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            out.append((self.long_item[which], self.long_at[which], array[place], self.window))
        for item, row in self.short:
            prefix = struct.pack(f">{len(row)}I", *row)
            rest = 4 * self.window - len(prefix)
            low = np.searchsorted(keys, np.array([prefix], keys.dtype), "left")[0]
            high = np.searchsorted(keys, np.array([prefix + b"\xff" * rest], keys.dtype), "left")[0]
            k = high - low
            out.append((np.full(k, item), np.zeros(k, "<i4"), array[low:high], len(row)))
        return out


def longest(item: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, words: int) -> np.ndarray:
    """Join windows that continue each other in the item and in the text: maximal verbatim matches."""
    out = np.empty(len(item), MATCH)
    out["item"], out["item_at"], out["doc_at"], out["words"] = item, item_at, doc_at, words
    if len(out) < 2:
        return out
    shift = out["doc_at"].astype(np.int64) - out["item_at"]
    out = out[np.lexsort((out["doc_at"], shift, out["item"]))]
    shift = out["doc_at"].astype(np.int64) - out["item_at"]
    new = np.append(
        True,
        (out["item"][1:] != out["item"][:-1]) | (shift[1:] != shift[:-1]) | (np.diff(out["doc_at"]) > 1),
    )
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(out)))
    out = out[first]
    out["words"] = size - 1 + words
    return out


def search(docs: DataFrame, items: list[tuple[int, str]], window: int) -> DataFrame:
    """Add the matches of one block of test items to the columns ``n_words`` and ``matches``."""
    target = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(items, window)
        get = tests.number.get
        for batch in batches:
            found, counts = [], []
            texts = batch.column("text").to_pylist()
            begin = 0
            while begin < len(texts):
                end, size, ids, first = begin, 0, [], [0]
                while end < len(texts) and (end == begin or size + len(texts[end] or "") <= SLICE_CHARS):
                    words = words_of(texts[end])
                    ids += map(get, words, (0,) * len(words))
                    counts.append(len(words))
                    ids += (0,) * window  # no match across documents
                    first.append(len(ids))
                    size += len(texts[end] or "")
                    end += 1
                first = np.array(first)
                parts = [
                    longest_in(first, *hit) for hit in tests.find(np.array(ids, np.int64)) if len(hit[0])
                ]
                rows: dict[int, list[np.ndarray]] = {}
                for part in parts:
                    for doc, some in part:
                        rows.setdefault(doc, []).append(some)
                for doc in range(end - begin):
                    found.append(b"".join(x.tobytes() for x in rows.get(doc, ())))
                begin = end
            before = batch.column("matches").to_pylist()
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["matches"] = pa.array([(a or b"") + b for a, b in zip(before, found)], pa.binary())
            yield pa.RecordBatch.from_arrays([columns[c] for c in target.names], schema=target)

    return docs.mapInArrow(released(run), docs.schema)


def longest_in(first: np.ndarray, item, item_at, at, words: int) -> list[tuple[int, np.ndarray]]:
    """Maximal matches by document; ``first`` has the first word of each document of the shard."""
    order = np.argsort(at, kind="stable")
    item, item_at, at = item[order], item_at[order], at[order]
    doc = np.searchsorted(first, at, "right") - 1
    cuts = np.flatnonzero(np.diff(doc)) + 1
    out = []
    for part in np.split(np.arange(len(at)), cuts):
        d = int(doc[part[0]])
        out.append((d, longest(item[part], item_at[part], at[part] - first[d], words)))
    return out


def covered(matches: np.ndarray) -> int:
    """Words of the document inside any match."""
    if not len(matches):
        return 0
    order = np.argsort(matches["doc_at"], kind="stable")
    begin = matches["doc_at"][order].astype(np.int64)
    end = begin + matches["words"][order]
    reach = np.maximum.accumulate(end)
    begin = np.maximum(begin, np.append(0, reach[:-1]))
    return int(np.maximum(end - begin, 0).sum())


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """Test items in blocks of about ``block_bytes``; one block at a time is on the driver."""
    items = benchmark.select(benchmark["item_id"].alias("item_id"), benchmark["text"].alias("text"))
    items = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, text, n_words, matches`` of every document, and the columns in ``carry``.

    ``matches`` holds records of :data:`MATCH`: where each maximal verbatim match of at least
    ``window`` words (or of a whole shorter item) begins in item and document, and its length.
    A null text has no words; items without id, text or words match nothing; repeated
    rows pass through; an empty table on either side gives no matches; further columns
    are not read unless carried.
    """
    own = {
        "doc_id": docs["doc_id"],
        "text": docs["text"],
        "n_words": F.lit(0).cast("long"),
        "matches": F.lit(None).cast("binary"),
    }
    out = docs.select(*[c.alias(name) for name, c in (own | (carry or {})).items()])
    for k, items in enumerate(item_blocks(benchmark, block_bytes)):
        if k and k % 8 == 0:
            out = materialize(out, "matches")
        out = search(out, items, window)
    return out


def flag(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words hit, items found and whether a twentieth of its words is hit."""
    found = find_matches(docs, benchmark, window, block_bytes).drop("text")
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    target = arrow_schema(docs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = batch.column("n_words").to_pylist()
            hits, items = [], []
            for raw in batch.column("matches").to_pylist():
                m = np.frombuffer(raw or b"", MATCH)
                hits.append(covered(m))
                items.append(sorted(map(str, set(m["item"].tolist()))))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": n_words,
                    "n_hit": hits,
                    "n_items": [len(x) for x in items],
                    "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
                    "contaminated": [h > 0 and 20 * h >= n for h, n in zip(hits, n_words)],
                },
                schema=target,
            )

    return found.mapInArrow(released(run), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, with all their own columns.

    A null or empty text has no words and stays; null ids and repeated rows are judged like others; an empty table gives no
    rows, and without items every document stays; texts of any length are searched whole.
    """

    @F.pandas_udf("boolean")
    def clean(matches: pd.Series, n_words: pd.Series) -> pd.Series:
        hits = matches.map(lambda raw: covered(np.frombuffer(raw or b"", MATCH)))
        return (hits == 0) | (20 * hits < n_words)

    # Under names of our own, so that no column of the table can clash.
    carry = {f"own{i}": docs[c] for i, c in enumerate(docs.columns) if c != "text"}
    found = find_matches(docs, benchmark, window, carry=carry).where(clean("matches", "n_words"))
    back = {c: f"own{i}" for i, c in enumerate(docs.columns)}
    return found.select(*[found["text" if c == "text" else back[c]].alias(c) for c in docs.columns])
