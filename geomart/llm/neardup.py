"""Near-duplicate documents: a multi-index Hamming join of b-bit MinHash signatures.

1. Documents with equal shingle sets are one class; only classes are compared.
2. A signature has 64 symbols of 16 bits in 16 chunks of 4. Two signatures that differ in at
   most ``MAX_DISTANCE`` = 31 symbols have, by the pigeonhole principle, a chunk with at most
   one error. Each class is entered under each chunk with each one symbol left out (64 keys),
   so every such pair shares a key. Sets with similarity 0.75 differ in 16 symbols on average;
   the chance of more than 31 is about 1.5e-5.
3. Per key, each class is compared with the key's smallest class only. What links is
   confirmed on the full sets and joined into components, which dissolves groups of copies in linear time.
4. Exact rest: keys that still hold several components are cut into blocks; a task gets two
   blocks, finds the classes with a signature near one of another component, and a
   second pass over just these confirms on full sets, until components are linked. No pairs are
   emitted but confirmed links between components, and no key is capped.

Steps between the parts are written tables below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, released, texts_of
from geomart.llm.shingles import SYMBOLS, WordHashes, set_digest, shingle_set, signature
from geomart.session import materialize

CHUNK = 4
MAX_DISTANCE = 2 * (SYMBOLS // CHUNK) - 1
BLOCK = 1024
NEED = 75  # percent of the union

SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"


def similar(n_both: np.ndarray | int, n_a: np.ndarray | int, n_b: np.ndarray | int):
    return 100 * n_both >= NEED * (n_a + n_b - n_both)


def sign(docs: DataFrame) -> DataFrame:
    """Set size, digest and signature of every document; a text without words has neither of the last two."""
    target = arrow_schema(docs, SIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = (shingle_set(t.as_py(), hashes) for t in b.column("text"))
            rows = [(len(s), set_digest(s), signature(s).tobytes()) if len(s) else (0, None, None) for s in sets]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), target.types[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], schema=target)

    return docs.mapInArrow(released(run), SIGNED)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """The 64 keys of each signature: a chunk's other three symbols, its number and the place left out."""
    chunks = signatures.astype(np.uint64).reshape(len(signatures), -1, CHUNK)
    out = []
    for left_out in range(CHUNK):
        a, b, c = (chunks[:, :, i] for i in range(CHUNK) if i != left_out)
        number = np.arange(chunks.shape[1], dtype=np.uint64)[None, :] * np.uint64(CHUNK) + np.uint64(left_out)
        out.append((a << np.uint64(32) | b << np.uint64(16) | c) | number << np.uint64(48))
    return np.concatenate(out, axis=1).astype(np.int64)


def index(classes: DataFrame) -> DataFrame:
    """``key, node``: every class under its 64 keys."""
    schema = "key long, node long"
    target = arrow_schema(classes, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b"".join(b.column("signature").to_pylist())
            keys = keys_of(np.frombuffer(raw, "<u2").reshape(-1, SYMBOLS))
            nodes = np.repeat(b.column("node").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], schema=target)

    return classes.select("node", "signature").mapInArrow(released(run), schema)


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``node, label`` for all nodes with a link: the smallest node that can be reached.

    Each round takes the smallest label among the neighbours, then the label of that label, and is
    written, so that rounds don't pile up. ``labels`` are those of an earlier call.
    """
    if labels is not None:  # links of an earlier call are kept as links to their labels
        edges = edges.unionAll(labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    now = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label"))
    now = materialize(now, "labels")
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = now.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = now.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = step.join(up, "label").select("node", "old", F.least("label", "up").alias("label"))
        step = materialize(step, "labels")
        now = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return now


def set_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` of the given classes (``node, rep``), made again from the texts of their documents."""
    schema = "node long, shingles binary"
    target = arrow_schema(docs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [shingle_set(t.as_py(), hashes) for t in b.column("text")]
            same = [set_digest(s) == d for s, d in zip(sets, b.column("digest").to_pylist())]  # an id may be repeated
            out = pa.RecordBatch.from_arrays([b.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], schema=target)
            yield out.filter(pa.array(same))

    joined = docs.join(nodes, docs["doc_id"] == nodes["rep"]).select("node", "digest", "text")
    return joined.mapInArrow(released(run), schema).groupBy("node").agg(F.first("shingles").alias("shingles"))


def as_set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar on their full sets."""
    schema = "a long, b long"
    target = arrow_schema(pairs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = as_set(x.as_py()), as_set(y.as_py())
                good.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], schema=target).filter(pa.array(good))

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(released(run), schema)


def distance_ok(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(1) <= MAX_DISTANCE


def near_signatures(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures differ in at most ``MAX_DISTANCE`` symbols."""
    schema = "a long, b long"
    target = arrow_schema(pairs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, SYMBOLS) for c in ("sa", "sb"))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], schema=target).filter(pa.array(distance_ok(x, y)))

    a = signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    b = signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(released(run), schema)


def by_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``work`` to each group of rows; groups are bounded, and stream by in sorted order."""
    target = arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            table = pa.Table.from_batches([b])
            rest = table if rest is None else pa.concat_tables([rest, table])
            code = [rest.column(k).to_numpy() for k in keys]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in code], axis=0)) + 1
            done = int(cuts[-1]) if len(cuts) else 0
            yield from emit(rest.slice(0, done), cuts[:-1])
            rest = rest.slice(done)
        if rest is not None and len(rest):
            yield from emit(rest, np.zeros(0, int))

    def emit(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in target.names}
        edges = [0, *cuts.tolist(), len(table)]
        table = table.combine_chunks()
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                for row in work(table.slice(a, b - a)):
                    for c in target.names:
                        out[c].append(row[c])
        if out[target.names[0]]:
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(released(run), schema)


def in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Cut each key into blocks of about ``block`` classes; ``key, i, j`` names a pair of blocks (``i <= j``)."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    out = members.join(sizes, "key").withColumn("own", own)
    out = out.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return out.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *[c for c in members.columns if c != "key"]
    )


def near_nodes(blocks: DataFrame) -> DataFrame:
    """``key, i, j, own, node, label``: classes with a near signature of another component in the pair of blocks."""
    schema = "key long, i int, j int, own int, node long, label long"

    def work(t: pa.Table) -> Iterator[dict]:
        label, own = t.column("label").to_numpy(), t.column("own").to_numpy()
        sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)
        key, i, j = (t.column(c)[0].as_py() for c in ("key", "i", "j"))
        keys = keys_of(sig)
        place = (key >> 48) & 0xFFFF
        column = place % CHUNK * (SYMBOLS // CHUNK) + place // CHUNK
        found = np.zeros(len(label), bool)
        for x in range(len(label) - 1):
            y = np.flatnonzero(label[x + 1 :] != label[x]) + x + 1
            y = y[own[y] != own[x]] if i != j else y
            y = y[distance_ok(sig[y], sig[x])] if len(y) else y
            if len(y):  # a pair is dealt with in the first of the keys it shares
                y = y[(keys[y] == keys[x]).argmax(1) == column]
                found[y] = True
                found[x] |= len(y) > 0
        for x in np.flatnonzero(found).tolist():
            yield {"key": key, "i": i, "j": j, "own": int(own[x]), "node": t.column("node")[x].as_py(), "label": int(label[x])}

    return by_group(blocks, ["key", "i", "j"], work, schema)


def link_blocks(blocks: DataFrame) -> DataFrame:
    """Confirmed links ``a, b`` between components of a pair of blocks, enough to join all that are linked."""
    schema = "a long, b long"

    def work(t: pa.Table) -> Iterator[dict]:
        nodes, own = t.column("node").to_pylist(), t.column("own").to_pylist()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sets = [as_set(x.as_py()) for x in t.column("shingles")]
        size = np.array([len(s) for s in sets])
        parent = {x: x for x in t.column("label").to_pylist()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        labels = t.column("label").to_pylist()
        # all shingles of the group, with who has them: one look-up counts a class's overlap with all
        flat = np.concatenate(sets)
        who = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(flat, kind="stable")
        flat, who = flat[order], who[order]
        for x in range(len(sets) - 1):
            low, high = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
            count = high - low
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            both = np.bincount(who[at], minlength=len(sets))
            for y in np.flatnonzero(similar(both, size[x], size)).tolist():
                if y <= x or (i != j and own[x] == own[y]):
                    continue
                a, b = root(labels[x]), root(labels[y])
                if a != b:
                    parent[a] = b
                    yield {"a": nodes[x], "b": nodes[y]}

    return by_group(blocks, ["key", "i", "j"], work, schema)


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    A null or wordless text has an empty set and is linked with nothing. Equal sets are linked.
    Rows with a null id are linked with nothing, keep a null component and are kept. Rows that repeat an id
    share its component if their texts are linked and each come back. An empty table gives no
    rows; further columns are not read.
    """
    texts = texts_of(docs, id_col, text_col)
    signed = materialize(sign(texts), "signed")
    classes = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"))
    # numbers are given once, when the table is written
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    entries = index(classes)
    shared = entries.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(shared.select("key", "pivot"), "shared-keys")
    members = materialize(entries.join(shared, "key"), "members")

    signatures = classes.select("node", "signature")
    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = materialize(near_signatures(pairs, signatures), "near-pairs")
    used = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    reps = classes.select("node", "rep", "digest")
    sets = materialize(set_table(texts, reps.join(used, "node")), "sets")
    labels = components(confirm(pairs, sets))

    # keys that hold more than one component
    label = F.coalesce("label", "node")
    left = members.select("key", "node").join(labels, "node", "left").select("key", "node", label.alias("label"))
    left = materialize(left, "labelled-members")
    mixed = left.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    left = left.join(mixed, "key")
    near = materialize(near_nodes(in_blocks(left, block).join(signatures, "node")), "near-nodes")
    more = near.select("node").distinct()
    sets = materialize(set_table(texts, reps.join(more, "node")), "sets")
    links = link_blocks(near.join(sets, "node"))
    labels = components(links, labels)

    named = classes.join(labels, "node", "left").select("digest", "rep", label.alias("label"))
    roots = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(roots, "label").select("digest", "component_id")
    out = signed.join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its own columns.

    Rows without id stay. Rows that share an id stay or go together, and equal ones among them once.
    """
    kept = cluster(docs).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    kept = materialize(kept.select(F.col("doc_id").alias("kept_id"), "times"), "kept")
    once = docs.join(kept.where("times = 1"), docs["doc_id"] == kept["kept_id"], "left_semi")
    again = docs.join(kept.where("times > 1"), docs["doc_id"] == kept["kept_id"], "left_semi").distinct()
    return once.unionAll(again).unionAll(docs.where(docs["doc_id"].isNull()))
