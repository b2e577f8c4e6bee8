"""Alignment of two tokenizers over the bytes of each text, in Arrow arrays from end to end.

Texts are cut where neither vocabulary has a token across, and each distinct stretch of a task's texts is
encoded and aligned once. There whole columns are worked on: lists of ids are flattened with the numbers of
their parents, byte lengths become running sums within each stretch, an Acero hash join on (stretch, end)
finds the ends that both tokenizers share, which number the groups, and a second one on the group gives the
links. A document takes the lists of its stretches (every stretch ends with a shared end, so its groups are
the document's), flattens them, and ``Table.group_by`` reduces them to distinct id pairs per document. Spark merges the partial
counts of pairs and gives each bucket of documents the counts of the pairs that it holds.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, released, texts_of
from geomart.session import materialize

#: From a blank after a non-blank to the next such place. No other white space begins a stretch, since
#: pieces may hold it after other signs; blanks never follow other signs within a piece (checked).
STRETCH = re.compile(r" \s*(?:\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*)?)?")
STRETCH_END = re.compile(r"\S(?= )")
SPACE_BLANK = re.compile(r"\s ")
#: The rule by which a byte-level vocabulary cuts texts before its merges. Fixed value.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SLICE_CHARS = 1_000_000
CACHE_STRETCHES = 250_000
BLOCK_STRETCHES = 500
LONG_STRETCH = 1_000
BUCKET_PAIRS = 1 << 20
#: Groups with more links than this have equal ids counted first, so that a long group isn't multiplied out.
SMALL_GROUP = 64

LINKED = (
    "doc_id long, bucket long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, links array<long>"
)
PAIRS = "bucket long, a int, b int, docs long"
IDS = pa.list_(pa.int32())
SUMMARY = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the
    next code point from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [c for c in range(256) if c not in set(seen)]
    return {chr(c): c for c in seen} | {chr(256 + i): c for i, c in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        signs = byte_signs()
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        plain = {e: bytes(signs[c] for c in e) for e in model["vocab"] if all(c in signs for c in e)}
        self.a_bytes = [b""] * (1 + max(model["vocab"].values()))
        for entry, i in model["vocab"].items():
            self.a_bytes[i] = plain.get(entry, entry.encode())
        # Merges in the order of their ids may be done by rank, which is faster and gives the same.
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        places = [model["vocab"][m] for m in merged]
        self.ranked = None
        if places == sorted(places) and all(len(plain.get(m, b"")) > 1 for m in merged):
            ranks = {plain[m]: model["vocab"][m] for m in merged} | {plain[s]: model["vocab"][s] for s in signs}
            self.ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)
        self.lead = len(self.b.encode("a"))  # what stands before a stretch, as the library adds a blank to a text
        self.a_size, self.b_size = (pa.array([len(t) for t in v], pa.int64()) for v in (self.a_bytes, self.b_bytes))

    def cut(self, text: str) -> list[str]:
        """Stretches of a blank and the text, each without its first blank."""
        if not self.cuttable:
            return [text]
        if text[:1] != " " and not SPACE_BLANK.search(text):
            return text.split(" ")
        return [c[1:] for c in STRETCH.findall(" " + text)]

    def encode(self, stretches: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Ids of each stretch on both sides, and whether both give its bytes; in a new order of ``stretches``."""
        together, apart = [], []
        for s in stretches:
            simple = self.cuttable and 0 < len(s) < LONG_STRETCH and not s[-1].isspace() and "▁" not in s
            (together if simple else apart).append(s)
        found = self.blocks(together) if together else None
        if not found:
            together, apart = [], stretches
        a, b, good = self.alone(apart)
        if found:
            a, b = pa.concat_arrays([found[0], a]), pa.concat_arrays([found[1], b])
        stretches[:] = together + apart
        return a, b, np.append(np.ones(len(together), bool), good)

    def alone(self, stretches: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Each stretch by itself."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]
        if self.cuttable:
            b = [ids[self.lead :] for ids in self.b.encode(["a " + s for s in stretches], num_threads=1)]
        else:
            b = self.b.encode(stretches, num_threads=1)
        join, ab, bb = b"".join, self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = [join(map(ab, x)) == (" " + s).encode() == join(map(bb, y)) for s, x, y in zip(stretches, a, b)]
        return pa.array(a, IDS), pa.array(b, IDS), np.array(good, bool)

    def blocks(self, stretches: list[str]) -> tuple[pa.ListArray, pa.ListArray] | None:
        """Stretches that end in a sign, encoded many at a time and parted at their ends.

        None if the ids don't give the bytes of the blocks; then the stretches have to be tried one by one.
        """
        blocks = [" " + " ".join(stretches[i : i + BLOCK_STRETCHES]) for i in range(0, len(stretches), BLOCK_STRETCHES)]
        raw = "".join(blocks).encode()
        ends = np.cumsum([len(s.encode()) + 1 for s in stretches])
        if self.ranked:
            a = [self.ranked.encode_ordinary(t) for t in blocks]
        else:
            a = [e.ids for e in self.a.encode_batch_fast(blocks, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in blocks], num_threads=1)
        out = []
        for ids, sizes, known in ((a, self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes)):
            ids = np.fromiter(chain.from_iterable(ids), np.int32, sum(map(len, ids)))
            at = np.cumsum(sizes.to_numpy()[ids])
            closes = np.minimum(np.searchsorted(at, ends), len(at) - 1)
            if (at[closes] != ends).any() or b"".join(map(known.__getitem__, ids.tolist())) != raw:
                return None
            out.append(pa.ListArray.from_arrays(pa.array(np.append(0, closes + 1), pa.int32()), pa.array(ids)))
        return out[0], out[1]


def counts(of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, minlength=n)


def starts(of: np.ndarray, n: int) -> pa.Array:
    """Offsets of the runs 0 to n - 1 in a sorted array."""
    return pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())


def laid_out(lists: pa.ListArray, size: pa.Array) -> pa.Table:
    """Tokens one after the other: id, stretch, and the end of its bytes.

    Ends go on from the stretch before, as if all lay end to end, so an end stands for one place of one
    stretch; that is the key (stretch, end) in one number.
    """
    tokens = pc.list_flatten(lists)
    ends = pc.cumulative_sum(pc.take(size, tokens))
    rows = pa.array(np.arange(len(tokens)))
    return pa.table({"id": tokens, "own": pc.list_parent_indices(lists), "end": ends, "row": rows})


def align(a_lists: pa.ListArray, b_lists: pa.ListArray, a_size: pa.Array, b_size: pa.Array) -> dict[str, pa.Array]:
    """Of each stretch, whose tokens have equal bytes on both sides: ``n_a, n_b, n_groups, n_links, groups`` (the groups
    as text) and the lists ``key`` (``a << 32 | b``) and ``links`` of its distinct linked id pairs."""
    n = len(a_lists)
    a, b = laid_out(a_lists, a_size), laid_out(b_lists, b_size)
    shared = a.select(["end", "row"]).join(
        b.select(["end", "row"]), keys="end", join_type="inner", right_suffix="_b", use_threads=False
    )
    n_groups = len(shared)
    group = {}
    for side, table, rows in (("a", a, shared["row"]), ("b", b, shared["row_b"])):
        closes = np.zeros(len(table), np.int64)
        closes[rows.to_numpy()] = 1
        group[side] = np.cumsum(closes) - closes  # the groups closed before a token
    own = np.zeros(n_groups, np.int64)
    own[group["a"]] = a["own"].to_numpy()
    size = {side: counts(group[side], n_groups) for side in group}
    first = {side: np.cumsum(size[side]) - size[side] for side in group}
    products = size["a"] * size["b"]

    sides = {}
    for side, table in (("a", a), ("b", b)):
        t = pa.table({"group": pa.array(group[side]), side: table["id"], f"n_{side}": pa.array(np.ones(len(table), np.int64))})
        long = pa.array(products[group[side]] > SMALL_GROUP)
        merged = t.filter(long).group_by(["group", side], use_threads=False).aggregate([(f"n_{side}", "sum")])
        merged = merged.rename_columns({f"n_{side}_sum": f"n_{side}"}).select(t.column_names)
        sides[side] = pa.concat_tables([t.filter(pc.invert(long)), merged.cast(t.schema)])
    links = sides["a"].join(sides["b"], keys="group", join_type="inner", use_threads=False)
    key = pc.bit_wise_or(pc.shift_left(pc.cast(links["a"], pa.int64()), 32), pc.cast(links["b"], pa.int64()))
    n_links = pc.multiply(links["n_a"], links["n_b"])
    links = pa.table({"own": pc.take(pa.array(own), links["group"]), "key": key, "links": n_links})

    shown = []
    for side, table in (("a", a), ("b", b)):
        ids = flat(pc.cast(table["id"], pa.string()))
        at_group = pa.array(np.append(first[side], len(ids)), pa.int32())
        shown.append(pc.binary_join(pa.ListArray.from_arrays(at_group, ids), ","))
    groups = pc.binary_join(pa.ListArray.from_arrays(starts(own, n), pc.binary_join_element_wise(*shown, "|")), ";")
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, own, products)
    return {
        "n_a": pa.array(counts(a["own"].to_numpy(), n)),
        "n_b": pa.array(counts(b["own"].to_numpy(), n)),
        "n_groups": pa.array(counts(own, n)),
        "n_links": pa.array(n_links),
        "groups": groups,
        **pair_lists(links, n),
    }


def pair_lists(links: pa.Table, n: int) -> dict[str, pa.Array]:
    """``own, key, links`` with equal keys of one owner added up, as lists of the owners 0 to n - 1."""
    t = links.group_by(["own", "key"], use_threads=False).aggregate([("links", "sum")]).sort_by("own")
    at = starts(t["own"].to_numpy(), n)
    return {"key": pa.ListArray.from_arrays(at, flat(t["key"])), "links": pa.ListArray.from_arrays(at, flat(t["links_sum"]))}


SUMS = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Texts to figures and pairs; remembers the first ``CACHE_STRETCHES`` stretches, others for one slice."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.known: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        empty = pa.array([], IDS)
        self.columns = align(empty, empty, tokenizers.a_size, tokenizers.b_size)

    def learn(self, stretches: set[str]) -> None:
        """Encode and align the stretches that aren't known yet."""
        if len(self.known) > CACHE_STRETCHES:
            self.known = dict(islice(self.known.items(), CACHE_STRETCHES))
            self.good = self.good[:CACHE_STRETCHES]
            self.columns = {c: x[:CACHE_STRETCHES] for c, x in self.columns.items()}
        new = list(stretches.difference(self.known))
        if not new:
            return
        t = self.tokenizers
        a, b, good = t.encode(new)
        none = pa.array([[]], IDS)
        kept = pa.array(np.where(good, np.arange(len(new)), len(new)))  # a stretch that isn't whole has no tokens
        a, b = (pa.concat_arrays([x, none]).take(kept) for x in (a, b))
        more = align(a, b, t.a_size, t.b_size)
        self.known |= zip(new, range(len(self.known), len(self.known) + len(new)))
        self.good = np.append(self.good, good)
        self.columns = {c: pa.concat_arrays([x, more[c]]) for c, x in self.columns.items()}

    def texts(self, texts: list[str | None]) -> pa.Table:
        """One row per text, a blank before it: the figures, ``groups``, and the lists ``a, b, links`` of id pairs.

        None has no tokens; nor has a text whose tokens don't give its bytes, whose ``groups`` are null.
        """
        n = len(texts)
        units = [[] if t is None else self.tokenizers.cut(t) for t in texts]
        self.learn(set().union(*units))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(units)), np.int64, sum(map(len, units)))
        doc = np.repeat(np.arange(n), [len(u) for u in units])
        # Pieces are never longer than their text, so a difference in one stretch can't be made good by another.
        whole = np.ones(n, bool)
        whole[doc[~self.good[at]]] = False
        at, doc = at[whole[doc]], doc[whole[doc]]
        rows = pa.array(at)
        out = {}
        for c in SUMS:
            out[c] = np.zeros(n, np.int64)
            np.add.at(out[c], doc, self.columns[c].to_numpy()[at])
        groups = pc.binary_join(pa.ListArray.from_arrays(starts(doc, n), self.columns["groups"].take(rows)), ";")
        keys = self.columns["key"].take(rows)
        links = pa.table(
            {
                "own": pc.take(pa.array(doc), pc.list_parent_indices(keys)),
                "key": pc.list_flatten(keys),
                "links": pc.list_flatten(self.columns["links"].take(rows)),
            }
        )
        return pa.table(out | {"groups": pc.if_else(pa.array(whole), groups, None)} | pair_lists(links, n))

    def long_text(self, text: str, limit: int) -> tuple[pa.Table, str]:
        """As :meth:`texts` for one text that is worked on part by part, and the digest of its groups."""
        h, sums, links = hashlib.sha256(), np.zeros(len(SUMS), np.int64), []
        whole = not self.tokenizers.cuttable
        for part in (text,) if whole else (p[1:] for p in parts(" " + text, limit)):
            t = self.texts([part])
            groups = t["groups"][0].as_py()
            if groups is None:
                return self.texts([None]), ""
            h.update((";" if sums[0] else "").encode() + groups.encode())
            sums += [t[c][0].as_py() for c in SUMS]
            links.append(pa.table({c: flat(pc.list_flatten(t[c])) for c in ("key", "links")}))
            if len(links) > 15:
                links = [merged_pairs(links)]
        own = merged_pairs(links)
        own = own.append_column("own", pa.array(np.zeros(len(own), np.int64)))
        return pa.table({c: [x] for c, x in zip(SUMS, sums)} | pair_lists(own, 1)), h.hexdigest()


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker."""
    return Aligner(Tokenizers(a_path, b_path))


def merged_pairs(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by("key", use_threads=False).aggregate([("links", "sum")])
    return t.rename_columns({"links_sum": "links"})


def parts(text: str, limit: int) -> Iterator[str]:
    """A text in parts of about ``limit`` characters, cut where stretches are."""
    at = 0
    while at < len(text):
        found = STRETCH_END.search(text, at + limit) if len(text) - at > limit else None
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


def flat(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def linked(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``doc_id, bucket, n_a, n_b, n_groups, n_links, groups_sha256, a, b, links`` of every document.

    ``a[i], b[i]`` are the distinct linked id pairs and ``links[i]`` how many links of the document they are.
    Null and empty texts, and texts that the tokens of one side don't give back byte by byte, have no tokens:
    zeros, no pairs and no digest. Null ids and repeated rows pass through, each row as a document of its own; an empty table gives no
    rows; further columns are not read; very long texts are worked on in parts. ``bucket`` deals rows out evenly by
    their pairs, whatever the ids are; it depends on the order of reading, so write the result before using it twice.
    """
    target = arrow_schema(docs, LINKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = aligner(a_path, b_path)
        task, held = TaskContext.get().partitionId(), 0

        def out(ids: list, t: pa.Table, digests: list[str]) -> pa.RecordBatch:
            nonlocal held
            weight = pc.list_value_length(t["key"]).to_numpy() + 16
            bucket = (task << 24) + (held + np.cumsum(weight) - weight) // BUCKET_PAIRS
            held += int(weight.sum())
            key, links = flat(t["key"]), flat(t["links"])
            pairs = pc.list_flatten(key)
            sides = {"a": pc.shift_right(pairs, 32), "b": pc.bit_wise_and(pairs, 0xFFFFFFFF)}
            at = pa.array(np.append(0, np.cumsum(weight - 16)), pa.int32())
            own = {c: pa.ListArray.from_arrays(at, x.cast(pa.int32())) for c, x in sides.items()}
            own |= {c: flat(t[c]) for c in SUMS} | {"links": pa.ListArray.from_arrays(at, pc.list_flatten(links))}
            own |= {"doc_id": pa.array(ids, pa.int64()), "bucket": pa.array(bucket), "groups_sha256": pa.array(digests)}
            return pa.RecordBatch.from_arrays([own[f.name].cast(f.type) for f in target], schema=target)

        def short(ids: list, texts: list[str | None]) -> pa.RecordBatch:
            t = v.texts(texts)
            return out(ids, t, [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in t["groups"].to_pylist()])

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if len(text) > slice_chars:
                    t, digest = v.long_text(text, slice_chars)
                    yield out([doc_id], t, [digest])
                    continue
                ids.append(doc_id)
                texts.append(text or None)
                size += len(text)
                if size > slice_chars:
                    yield short(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield short(ids, texts)

    return texts_of(docs, id_col, text_col).mapInArrow(released(run), LINKED)


def bucket_pairs(rows: DataFrame) -> DataFrame:
    """``bucket, a, b, docs``: in how many documents of a bucket each id pair is linked."""
    target = arrow_schema(rows, PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column("a")
            t = pa.table(
                {
                    "bucket": pc.take(batch.column("bucket"), pc.list_parent_indices(a)),
                    "a": pc.list_flatten(a),
                    "b": pc.list_flatten(batch.column("b")),
                }
            )
            t = t.group_by(["bucket", "a", "b"], use_threads=False).aggregate([([], "count_all")])
            yield from t.rename_columns({"count_all": "docs"}).select(target.names).cast(target).to_batches()

    partial = rows.select("bucket", "a", "b").mapInArrow(released(run), PAIRS)
    return partial.groupBy("bucket", "a", "b").agg(F.sum("docs").alias("docs"))


def pair_counts(per_bucket: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents of the whole corpus that hold a pair, and whether no pair of ``a`` has more."""
    totals = per_bucket.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    most = totals.groupBy("a").agg(F.max("count").alias("most"))
    return totals.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def summary(docs: DataFrame, a_path: str, b_path: str, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Figures of every document (see :func:`linked`), with the links that are best for their first id
    (``n_best``) and the corpus counts of all links together (``count_sum``)."""
    rows = materialize(linked(docs, a_path, b_path, slice_chars=slice_chars), "alignment")
    per_bucket = materialize(bucket_pairs(rows), "alignment-pairs")
    back = per_bucket.select("bucket", "a", "b").join(pair_counts(per_bucket), ["a", "b"])
    target = arrow_schema(docs, SUMMARY)

    def weigh(own: pa.Table, known: pa.Table) -> pa.Table:
        lists = [flat(own[c]) for c in ("a", "b", "links")]
        flats = [pc.list_flatten(x) for x in lists]
        t = pa.table({"row": pc.list_parent_indices(lists[0]), **dict(zip(("a", "b", "links"), flats))})
        t = t.join(known.select(["a", "b", "count", "best"]), keys=["a", "b"], join_type="inner", use_threads=False)
        best = pc.multiply(t["links"], pc.cast(t["best"], pa.int64()))
        t = pa.table({"row": t["row"], "n_best": best, "count_sum": pc.multiply(t["links"], t["count"])})
        t = t.group_by("row", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        out = {c: own[c] for c in target.names if c in own.column_names}
        for c in ("n_best", "count_sum"):
            x = np.zeros(len(own), np.int64)
            x[t["row"].to_numpy()] = t[f"{c}_sum"].to_numpy()
            out[c] = pa.array(x)
        return pa.table({c: out[c] for c in target.names}).cast(target)

    return rows.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(weigh, SUMMARY)
