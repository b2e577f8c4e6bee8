"""Byte ranges that an earlier document holds too, by a column-wise built collection BWT.

Which 50-byte strings of a document also start in a document with a smaller id? Equal strings must
meet in one task, but the corpus must not. So each document is cut at minimizers: all 50-byte strings
in a row with the same smallest 16-byte substring form one piece of 50 to 84 bytes, and the
hash of that substring is the piece's bucket.

1. Minimizer hashes go to their buckets; those that more than one document has are sent back to
   buckets of documents. What no other document can hold is left out from here on.
2. Each bucket of documents sends every distinct piece with such a minimizer, with its smallest
   id, to the piece's bucket. A passage in very many documents is one piece per bucket of documents.
3. A bucket of pieces is a collection. Its Burrows-Wheeler order is built column by column:
   round by round each piece gives its next symbol from the right, and the order of all
   suffixes so far is updated by one sequential pass. Neighbours with 50 bytes in common are one
   string; the smallest id of each goes back.
4. The buckets of documents mark, cover and hash.

The files of the method are Spark's shuffle files: a bucket is read from its start to its end and its arrays
stay in memory, as the number of buckets follows the bytes of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import BUCKET_BYTES, arrow_schema, in_buckets, texts_of
from geomart.llm.shingles import mix

LENGTH = 50
SEED = 16
SPAN = LENGTH - SEED + 1  # seeds in a string
WIDTH = LENGTH + SPAN - 1  # bytes of a piece at most
PART_BYTES = 1 << 19
COLLECTION = 4000  # pieces
PLACE = np.uint64((1 << 20) - 1)

MESSAGE = "bucket int, sender int, body binary"


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], "<i8").tobytes()
    return zstandard.ZstdCompressor(1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack(body: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    at = 8 * (1 + len(types))
    out = []
    for size, kind in zip(np.frombuffer(raw[8:at], "<i8").tolist(), types):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


_BYTES = np.random.RandomState(9).randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)]


def seeds(raw: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each place (the last 15 places have none)."""
    h = _BYTES[raw]
    for step, odd in zip((1, 2, 4, 8), _ODD):
        h = h[:-step] * odd + h[step:]
    return mix(h)


def parts(sizes: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of ``(document, from, to)`` of about ``PART_BYTES``; each string of ``LENGTH`` bytes lies in one part of its document."""
    group, size = [], 0
    for doc, n in enumerate(sizes):
        at = 0
        while n - at >= LENGTH:
            end = min(n, at + PART_BYTES + LENGTH - 1)
            if group and size + end - at > PART_BYTES:
                yield group
                group, size = [], 0
            group.append((doc, at, end))
            size += end - at
            at = end - LENGTH + 1
    if group:
        yield group


def pieces_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each group of parts: bytes, and document, place in the bytes, shift to the place in the document, strings and seed of each piece."""
    for group in parts([len(t) for t in texts]):
        raw = np.frombuffer(b"".join(texts[d][a:b] for d, a, b in group), np.uint8)
        sizes = np.array([b - a for _, a, b in group])
        begin = np.cumsum(sizes) - sizes
        h = seeds(raw)
        n = len(raw) - LENGTH + 1
        best = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        covered = 1
        while covered < SPAN:  # smallest of SPAN seeds by doubling; of equal ones the leftmost
            step = min(covered, SPAN - covered)
            best = np.minimum(best[:-step], best[step:])
            covered += step
        at = (best[:n] & PLACE).astype(np.int64)
        owner = np.repeat(np.arange(len(group)), sizes)[:n]
        valid = np.arange(n) + LENGTH <= (begin + sizes)[owner]
        new = np.ones(n, bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new & valid)
        last = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
        own = owner[first]
        doc = np.array([d for d, _, _ in group])[own]
        shift = np.array([a for _, a, _ in group])[own] - begin[own]
        yield raw, doc, first, shift, last - first + 1, h[at[first]]


def bucket_of(seed: np.ndarray, buckets: int) -> np.ndarray:
    return ((seed & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)


def short(seed: np.ndarray) -> np.ndarray:
    """40 bits of a seed, enough within a bucket: two seeds taken for one only make a piece be looked at."""
    return seed >> np.uint64(24)


def by_value(value: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(value, kind="stable")
    cuts = np.flatnonzero(np.diff(value[order])) + 1
    for some in np.split(order, cuts):
        if len(some):
            yield int(value[some[0]]), some


class Pieces:
    """The distinct pieces of a bucket of documents whose seeds other documents have too.

    The order is a function of the rows, so both passes over the bucket agree.
    """

    def __init__(self, docs: pa.Table, wanted: pa.Table, buckets: int):
        rows = sorted(zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()), key=lambda r: (r[0] is None, r))
        self.ids = [r[0] for r in rows]
        self.texts = [r[1].encode() for r in rows]
        numbers = np.array([-1 if i is None else i for i in self.ids], np.int64)
        null = np.array([i is None for i in self.ids], bool)
        lists = [unpack(m, "<i8", "<u8") for m in wanted.column("body").to_pylist()]
        keys = [pair_hash(ids, seeds_, sender) for (ids, seeds_), sender in zip(lists, wanted.column("sender").to_pylist())]
        known = np.sort(np.concatenate(keys)) if keys else np.zeros(1, np.uint64)
        found = []
        for raw, doc, first, shift, strings, seed in pieces_of(self.texts):
            target = bucket_of(seed, buckets)
            ask = pair_hash(numbers[doc], short(seed), target)
            good = (known[np.minimum(np.searchsorted(known, ask), len(known) - 1)] == ask) & ~null[doc]
            doc, first, shift, strings, target, seed = (x[good] for x in (doc, first, shift, strings, target, seed))
            if not len(doc):
                continue
            size = strings + LENGTH - 1
            grid = np.minimum(first[:, None] + np.arange(WIDTH), len(raw) - 1)
            rows_ = np.where(np.arange(WIDTH) < size[:, None], raw[grid], 0).astype(np.uint8)
            rows_ = np.concatenate((rows_, size[:, None].astype(np.uint8)), axis=1)
            found.append((doc, first + shift, strings, target, seed, np.frombuffer(rows_.tobytes(), f"S{WIDTH + 1}")))
        if found:
            self.doc, self.start, self.strings, target, seed, raw_pieces = (np.concatenate(x) for x in zip(*found))
            self.distinct, one, self.which = np.unique(raw_pieces, return_index=True, return_inverse=True)
            self.target, self.length, self.seed = target[one], self.strings[one], (short(seed[one]) & np.uint64(0xFFFFFFFF)).astype("<u4")
            self.number = numbers[self.doc]
            self.least = np.full(len(self.distinct), np.iinfo(np.int64).max)
            np.minimum.at(self.least, self.which, self.number)
        else:
            self.distinct = np.zeros(0, f"S{WIDTH + 1}")
            self.seed = self.doc = self.start = self.strings = self.which = self.target = self.length = self.number = self.least = np.zeros(0, np.int64)


def pair_hash(doc: np.ndarray, seed: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    """One number for document and seed; two taken for one only make a piece be looked at."""
    return mix(doc.astype(np.uint64) * _ODD[0] + mix(seed << np.uint64(24) | np.asarray(bucket).astype(np.uint64)))


def column_order(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of a collection in order, as places in its bytes: one symbol per row and round.

    In round j the suffixes of up to j bytes are in order. The byte before each of them
    is the collection's Burrows-Wheeler transform so far; sorting it stably puts the suffixes
    that are one byte longer in order, after the empty ones. Rows that are used up drop out.
    """
    ends = np.cumsum(size + 1)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)  # 0 before each row; bytes are raised by one
    begin = ends - size
    at = np.arange(WIDTH) < size[:, None]
    flat[(begin[:, None] + np.arange(WIDTH))[at]] = rows[at] + 1
    # places fit 32 bits unless a bucket is far above its size; smaller arrays stay in the cache
    ends = ends.astype(np.int32 if len(flat) < 1 << 31 else np.int64)
    order = ends.copy()
    for _ in range(int(size.max()) if len(size) else 0):
        symbol = flat[order - 1]
        sorted_ = np.argsort(symbol, kind="stable")
        sorted_ = sorted_[np.count_nonzero(symbol == 0) :]
        order = np.concatenate((ends, order[sorted_] - 1))
    return order, begin


def smallest_ids(distinct: np.ndarray, least: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``LENGTH`` bytes in each piece (in a row) the smallest id of any piece that has it; and where each piece begins in that row.

    Pieces with different seeds have no string in common, so a piece that is alone with its
    seed is a collection of one and its own id the smallest; so is a piece none of whose strings has the hash of
    another piece's string, as most are where a seed stands in a great many contexts. The others are put in order.
    """
    grid = np.frombuffer(distinct.tobytes(), np.uint8).reshape(-1, WIDTH + 1)
    strings = grid[:, WIDTH].astype(np.int64) - LENGTH + 1
    offset = np.cumsum(strings) - strings
    out = np.repeat(least, strings)
    _, group, times = np.unique(seed, return_inverse=True, return_counts=True)
    several = np.flatnonzero(times[group] > 1)
    several = several[share_a_hash(grid, strings, several)]
    several = several[np.argsort(group[several], kind="stable")]
    borders = np.append(np.flatnonzero(np.diff(group[several])) + 1, len(several))
    begin = 0
    while begin < len(several):  # whole groups, about so many pieces that their arrays stay in the cache
        end = int(borders[np.searchsorted(borders, min(begin + COLLECTION, len(several)))])
        part = several[begin:end]
        low, _ = compared(np.ascontiguousarray(grid[part]), least[part])
        n = strings[part]
        out[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offset[part], n)] = low
        begin = end
    return out, offset


def share_a_hash(grid: np.ndarray, strings: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """For each of ``pieces`` whether one of its strings has the hash of a string of another of them.

    Two strings taken for one only make their pieces be put in order; equal ones are never missed.
    """
    hashes = []
    for a in range(0, len(pieces), COLLECTION):
        some = pieces[a : a + COLLECTION]
        h = _BYTES[grid[some, :WIDTH]]
        for step, odd in zip((1, 2, 4, 8, 16), (*_ODD, _ODD[0])):
            h = h[:, :-step] * odd + h[:, step:]
        h = h[:, : SPAN] * _ODD[1] + h[:, LENGTH - 32 :]  # bytes 0 to 31 and 18 to 49 of each string
        hashes.append(mix(h)[np.arange(SPAN) < strings[some][:, None]])
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(pieces)), strings[pieces])
    order = np.argsort(hashes, kind="stable")  # equal hashes stay in the order of their pieces
    owner, new = owner[order], np.append(True, np.diff(hashes[order]) != 0)[: len(order)]
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(order) - 1)[: len(first)]
    met = np.zeros(len(pieces), bool)
    met[owner[np.repeat(owner[first] != owner[last], last - first + 1)]] = True
    return met


def compared(grid: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`smallest_ids`, by the order of all suffixes."""
    size = grid[:, WIDTH].astype(np.int64)
    rows = np.ascontiguousarray(grid[:, :WIDTH])
    order, begin = column_order(rows, size)
    strings = size - LENGTH + 1
    offset = np.cumsum(strings) - strings
    piece = np.searchsorted(begin, order, "right") - 1
    place = order - begin[piece]
    long_ = place < strings[piece]
    piece, place = piece[long_], place[long_]
    # neighbours in order with LENGTH bytes in common are the same string
    windows = np.lib.stride_tricks.sliding_window_view(rows.reshape(-1), LENGTH)
    same = np.zeros(len(piece), bool)
    for a in range(1, len(piece), 1 << 18):
        b = min(len(piece), a + (1 << 18))
        x = windows[piece[a:b] * WIDTH + place[a:b]]
        y = windows[piece[a - 1 : b - 1] * WIDTH + place[a - 1 : b - 1]]
        same[a:b] = (x == y).all(1)
    group = np.cumsum(~same) - 1
    low = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(low, group, least[piece])
    out = np.empty(int(strings.sum()), np.int64)
    out[offset[piece] + place] = low[group]
    return out, offset


def covered_runs(flagged: np.ndarray, n: int) -> np.ndarray:
    """Maximal ranges ``[begin, end)`` covered by strings that start at the flagged places (sorted)."""
    if not len(flagged):
        return np.zeros((0, 2), np.int64)
    new = np.append(True, np.diff(flagged) > LENGTH)
    begin = flagged[new]
    end = flagged[np.append(np.flatnonzero(new)[1:] - 1, len(flagged) - 1)] + LENGTH
    return np.stack([begin, np.minimum(end, n)], axis=1)


def repeated_ranges(docs: DataFrame, finish, schema: str, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``finish(id, text as bytes, removed ranges)`` of every document, a dict of the columns of ``schema``."""
    texts = in_buckets(texts_of(docs, id_col, text_col), bucket_bytes)
    buckets = texts.agg(F.max("bucket")).first()[0]
    buckets = 1 if buckets is None else buckets + 1
    message, final = arrow_schema(docs, MESSAGE), arrow_schema(docs, schema)

    def table(rows: list[tuple[int, int, bytes]]) -> dict:
        return dict(zip(message.names, map(list, zip(*rows)))) if rows else {c: [] for c in message.names}

    def send_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, senders = b.column("doc_id").to_pylist(), b.column("bucket").to_numpy()
            raw = [t.as_py().encode() if i is not None else b"" for i, t in zip(ids, b.column("text"))]
            numbers = np.array([-1 if i is None else i for i in ids], np.int64)
            found = [(doc, seed) for _, doc, _, _, _, seed in pieces_of(raw)]
            out = []
            if found:
                doc, seed = (np.concatenate(x) for x in zip(*found))
                for bucket, at in by_value(bucket_of(seed, buckets)):
                    entries = np.unique(doc[at].astype(np.uint64) << np.uint64(40) | short(seed[at]))
                    local = (entries >> np.uint64(40)).astype(np.int64)
                    held = np.unique(local)
                    low, high = (entries & np.uint64(0xFFFFFFFF)).astype("<u4"), (entries >> np.uint64(32) & np.uint64(0xFF)).astype("u1")
                    body = [numbers[held], senders[held].astype("<i4"), np.searchsorted(held, local).astype("<u4"), low, high]
                    out.append((bucket, 0, pack(*body)))
            yield pa.RecordBatch.from_pydict(table(out), schema=message)

    def return_shared(group: pa.Table) -> pa.Table:
        own = group.column("bucket")[0].as_py()
        ids, senders, seeds_ = [], [], []
        for body in group.column("body"):
            number, sender, code, low, high = unpack(body.as_py(), "<i8", "<i4", "<u4", "<u4", "u1")
            ids.append(number[code])
            senders.append(sender[code])
            seeds_.append(high.astype(np.uint64) << np.uint64(32) | low)
        ids, senders, seeds_ = np.concatenate(ids), np.concatenate(senders), np.concatenate(seeds_)
        order = np.lexsort((ids, seeds_))
        ids, senders, seeds_ = ids[order], senders[order], seeds_[order]
        new = np.append(True, seeds_[1:] != seeds_[:-1])
        group_of = np.cumsum(new) - 1
        first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:] - 1, len(ids) - 1)
        shared = (ids[first] != ids[last])[group_of]
        ids, senders, seeds_ = ids[shared], senders[shared], seeds_[shared]
        out = []
        for sender, at in by_value(senders):
            at = at[np.lexsort((seeds_[at], ids[at]))]
            out.append((sender, own, pack(ids[at], seeds_[at])))
        return pa.table(table(out), schema=message)

    def send_pieces(group: pa.Table, wanted: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table(table([]), schema=message)
        own = group.column("bucket")[0].as_py()
        p = Pieces(group, wanted, buckets)
        out = [(bucket, own, pack(p.distinct[at], p.least[at], p.seed[at])) for bucket, at in by_value(p.target)]
        return pa.table(table(out), schema=message)

    def compare(group: pa.Table) -> pa.Table:
        own, senders = group.column("bucket")[0].as_py(), group.column("sender").to_pylist()
        lists = [unpack(x.as_py(), f"S{WIDTH + 1}", "<i8", "<u4") for x in group.column("body")]
        distinct, one, which = np.unique(np.concatenate([x for x, _, _ in lists]), return_index=True, return_inverse=True)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, which, np.concatenate([y for _, y, _ in lists]))
        low, offset = smallest_ids(distinct, least, np.concatenate([z for _, _, z in lists])[one])
        strings = np.diff(np.append(offset, len(low)))
        out, done = [], 0
        for sender, (x, _, _) in zip(senders, lists):
            at = which[done : done + len(x)]
            done += len(x)
            n = strings[at]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offset[at], n)
            out.append((sender, own, pack(low[place])))
        return pa.table(table(out), schema=message)

    def mark(group: pa.Table, told: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table({c: [] for c in final.names}, schema=final)
        kinds = told.column("kind").to_numpy()
        p = Pieces(group, told.filter(pa.array(kinds == 0)), buckets)
        offset = np.cumsum(p.length) - p.length
        low = np.empty(int(p.length.sum()), np.int64)
        answers = told.filter(pa.array(kinds == 1))
        bodies = dict(zip(answers.column("sender").to_pylist(), answers.column("body").to_pylist()))
        for bucket, at in by_value(p.target):
            n = p.length[at]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offset[at], n)
            low[place] = unpack(bodies[bucket], "<i8")[0]
        n = p.strings
        which = np.repeat(np.arange(len(n)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = low[offset[p.which[which]] + inside] < p.number[which]
        doc, start = p.doc[which[hit]], (p.start[which] + inside)[hit]
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        cuts = np.searchsorted(doc, np.arange(len(p.ids) + 1))
        rows = [finish(i, t, covered_runs(start[cuts[k] : cuts[k + 1]], len(t))) for k, (i, t) in enumerate(zip(p.ids, p.texts))]
        return pa.table({c: [r[c] for r in rows] for c in final.names}, schema=final)

    shared = texts.mapInArrow(send_seeds, MESSAGE).groupBy("bucket").applyInArrow(return_shared, MESSAGE)
    sent = texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(send_pieces, MESSAGE)
    answers = sent.groupBy("bucket").applyInArrow(compare, MESSAGE)
    told = shared.withColumn("kind", F.lit(0)).unionAll(answers.withColumn("kind", F.lit(1)))
    return texts.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(mark, schema)


def cut_out(text: bytes, runs: np.ndarray) -> bytes:
    parts_, done = [], 0
    for a, b in runs.tolist():
        parts_.append(text[done:a])
        done = b
    return b"".join(parts_) + text[done:]


def summary(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A null text is empty; a text below 50 bytes loses nothing; a row with a null id loses nothing
    and takes nothing from others; rows that repeat an id don't count against each other;
    an empty table gives no rows; further columns are not read.
    """

    def finish(doc_id, text, runs):
        return {
            "doc_id": doc_id,
            "n_bytes": len(text),
            "n_removed": int((runs[:, 1] - runs[:, 0]).sum()),
            "n_spans": len(runs),
            "kept_sha256": hashlib.sha256(cut_out(text, runs)).hexdigest(),
        }

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeated_ranges(docs, finish, schema, bucket_bytes)


def ranges(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, removed (begin and end of each range), kept (the bytes that are left)``."""

    def finish(doc_id, text, runs):
        removed = [{"begin": a, "end": b} for a, b in runs.tolist()]
        return {"doc_id": doc_id, "removed": removed, "kept": cut_out(text, runs)}

    return repeated_ranges(docs, finish, "doc_id long, removed array<struct<begin:bigint,end:bigint>>, kept binary", bucket_bytes)
