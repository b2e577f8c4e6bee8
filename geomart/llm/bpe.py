"""Byte-level BPE by replaying merges over the distinct pieces of a part of the corpus.

The encoder does not treat occurrences one by one. The distinct pieces of a batch are laid
into one linked array of symbols; an inverted index holds, for each rank, the positions whose
pair joins to that rank; the ranks are then applied lowest first, all positions of a rank at
once, and each merge touches only its two neighbours. Occurrences look their ids up. Every task does this for the rows it
reads, so there is no shuffle, and memory is bounded by the batch and ``CACHE_PIECES``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, released, texts_of

#: Unicode White_Space, the meaning of \s in the tokenizer (Python's \s has four more). Fixed values.
SPACE = "\t-\r \x85\xa0  -     　"
CACHE_PIECES = 150_000
SLICE_CHARS = 2_000_000

SCHEMA = "doc_id long, ids binary, decoded binary"


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def pair_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys ``left << 32 | right`` of all pairs of tokens that join to a token, and its rank."""
    ranks = load_ranks(path)
    found = {}
    for whole, rank in ranks.items():
        for cut in range(1, len(whole)):
            x, y = ranks.get(whole[:cut]), ranks.get(whole[cut:])
            if x is not None and y is not None:
                found[x << 32 | y] = rank
    keys = np.array(sorted(found), np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], np.int64)


def merge_alone(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One piece by itself: always the lowest rank, leftmost first."""
    parts = [bytes((c,)) for c in piece]
    while len(parts) > 1:
        rank, i = min((ranks.get(x + y, 1 << 40), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 40:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def replay(pieces: list[bytes], ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """Ids of each piece (none empty) as little-endian u32: merges of all pieces, in rank order.

    A pair of a rank below the one at work can only come up where the merges of a piece don't
    follow the order in which the vocabulary was made; such a piece is merged alone.
    """
    if not pieces:
        return []
    size = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    first = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    sym = np.array([ranks[bytes((c,))] for c in range(256)], np.int64)[raw]
    sym[first + size] = -1  # no pair across pieces
    n = len(sym)
    left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
    sym, right = np.append(sym, -1), np.append(right, n)
    left = np.append(left, n - 1)
    keys, joined = pairs

    def ranked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = (x << 32) | y
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[at] == key) & (x >= 0) & (y >= 0), joined[at], -1)

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def note(r: np.ndarray, at: np.ndarray) -> None:
        """Put the positions into the index under their ranks."""
        good = r >= 0
        r, at = r[good], at[good]
        if not len(r):
            return
        order = np.argsort(r, kind="stable")
        r, at = r[order], at[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for rank, some in zip(r[np.append(0, cuts)].tolist(), np.split(at, cuts)):
            if rank in index:
                index[rank].append(some)
            else:
                index[rank] = [some]
                heapq.heappush(queue, rank)

    note(ranked(sym[:-1], sym[1:]), np.arange(n))
    odd: set[int] = set()
    while queue:
        rank = heapq.heappop(queue)
        some = index.pop(rank)
        at = some[0] if len(some) == 1 else np.unique(np.concatenate(some))
        at = at[ranked(sym[at], sym[right[at]]) == rank]  # a neighbour may have taken part of the pair
        if not len(at):
            continue
        if len(at) > 1 and (chain := at[1:] == right[at[:-1]]).any():  # in a run of pairs every other one merges
            k = np.arange(len(at))
            begin = np.maximum.accumulate(np.where(np.append(True, ~chain), k, 0))
            at = at[(k - begin) % 2 == 0]
        gone = right[at]
        after = right[gone]
        sym[at], sym[gone] = rank, -1
        right[at], left[after] = after, at
        before = left[at]
        r1, r2 = ranked(sym[at], sym[after]), np.where(before >= 0, ranked(sym[before], sym[at]), -1)
        r, touched = np.concatenate((r1, r2)), np.concatenate((at, before))
        if (low := (r >= 0) & (r < rank)).any():
            odd.update((np.searchsorted(first, touched[low], "right") - 1).tolist())
        note(r, touched)
    alive = sym[:n] >= 0
    count = np.add.reduceat(alive, first)
    flat = sym[:n][alive].astype("<u4").tobytes()
    stop = (np.cumsum(count) * 4).tolist()
    out = [flat[a:b] for a, b in zip([0, *stop], stop)]
    for i in odd:
        out[i] = np.array(merge_alone(pieces[i], ranks), "<u4").tobytes()
    return out


class Encoder:
    """Text to ids; remembers the ids of pieces and forgets them all beyond ``CACHE_PIECES``."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.ranks, self.pairs = load_ranks(ranks_path), pair_table(ranks_path)
        self.known: dict[str, bytes] = {}
        self.vocab = {i: t for t, i in self.ranks.items()}
        self.fine = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        # A match of the pattern lies inside one of these: a word with one space before it, or space.
        self.coarse = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        units = [self.coarse.findall(t) for t in texts]
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        new = list(set().union(*units).difference(self.known))
        # Letters after at most one space are one match of the pattern; only the others need cutting.
        parts = [[u] if u[u[0] == " " :].isalpha() else self.fine.findall(u) for u in new]
        pieces = list({p for ps in parts for p in ps})
        ids = dict(zip(pieces, replay([p.encode() for p in pieces], self.ranks, self.pairs)))
        for unit, ps in zip(new, parts):
            self.known[unit] = b"".join([ids[p] for p in ps])
        get = self.known.__getitem__
        return [b"".join(map(get, u)) for u in units]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[slice]:
    """Consecutive slices of at most ``limit`` characters (one text at least)."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def mapped(df: DataFrame, ranks_path: str, pattern: str, schema: str, finish) -> DataFrame:
    """One row per document from ``finish(doc_ids, ids, encoder)``, a dict of columns."""
    target = arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rest = batch.drop_columns(["text"])
            for part in slices(texts):
                encoded = encoder.encode(texts[part])
                out = finish(rest.slice(part.start, part.stop - part.start), encoded, encoder)
                yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.mapInArrow(released(run), schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids (little-endian u32), decoded (the ids turned back into bytes)`` of every text.

    A null text is the empty text and has no ids; a null id and repeated rows pass through;
    an empty table gives no rows; further columns of ``docs`` are not read.
    """

    def finish(rest, ids, encoder):
        return {"doc_id": rest.column("doc_id"), "ids": ids, "decoded": [encoder.decode(x) for x in ids]}

    return mapped(texts_of(docs, id_col, text_col), ranks_path, pattern, SCHEMA, finish)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """As :func:`encode`, but number and SHA-256 of the ids and of the decoded bytes."""

    def finish(rest, ids, encoder):
        return {
            "doc_id": rest.column("doc_id"),
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(texts_of(docs), ranks_path, pattern, schema, finish)


def with_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_tokens, ids (binary, little-endian u32)``.

    A null text is empty and has no ids; null ids and repeated rows pass through; an empty table gives no rows; texts of any
    length are encoded whole. Columns of ``docs`` by the names ``n_tokens`` and ``ids`` (in any case) are replaced.
    """
    rest = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "ids")]
    own = docs.select(*[docs[c].alias(f"own{i}") for i, c in enumerate(rest)], F.coalesce(docs["text"], F.lit("")).alias("text"))
    schema = own.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).withColumn("ids", F.lit(None).cast("binary")).schema

    def finish(columns, ids, encoder):
        return dict(zip(columns.schema.names, columns.columns)) | {"n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    out = mapped(own, ranks_path, pattern, schema, finish)
    return out.select(*[F.col(f"own{i}").alias(c) for i, c in enumerate(rest)], "n_tokens", "ids")
