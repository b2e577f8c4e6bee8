"""Quality of texts by how well they compress with a good and with a bad dictionary.

Two zstandard dictionaries are built from bounded samples of texts labelled good and bad.
Each whole text is compressed with both; the difference of the sizes over their sum,
with the sizes per byte, goes into a logistic curve fitted on other labelled texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, crc_of, released, texts_of

#: Labelled rows of each class, at most, that the dictionaries are made of; as many again fit the curve.
SAMPLE_ROWS = 1200
DICTIONARY_BYTES = 112 << 10
CHUNK_BYTES = 4096
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray  # of the features, the last one is the constant

    def scorer(self):
        """A function from whole texts to scores; made in each task."""
        packers = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d) if d else None,
                compression_params=zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, write_content_size=0, write_dict_id=0, write_checksum=0
                ),
            )
            for d in (self.good, self.bad)
        ]

        def features(text: str) -> list[float]:
            raw = text.encode()
            good, bad = (sum(len(p.compress(raw[i : i + CHUNK_BYTES])) for i in range(0, len(raw), CHUNK_BYTES)) for p in packers)
            n = max(1, len(raw))
            # the difference, over both sizes and over the bytes of the text, and how far the text compresses at all
            return [(bad - good) / max(1, bad + good), (bad - good) / n, min(2.0, good / n), min(2.0, bad / n), 1 / math.sqrt(n)]

        return features


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_curve(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton steps of a ridge logistic regression; rows are weighted to the true share of good texts."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = logistic(z @ w)
        grad = z.T @ (weight * (p - y)) + ridge * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[:-1] / scale
    return np.append(raw, w[-1] - raw @ mean)


def dictionary(texts: list[str]) -> bytes:
    """A dictionary from whole texts cut into chunks; empty if there is too little to build one."""
    chunks = [c for t in texts for c in (t.encode()[i : i + CHUNK_BYTES] for i in range(0, len(t.encode()), CHUNK_BYTES)) if len(c) >= 8]
    size = min(DICTIONARY_BYTES, sum(map(len, chunks)) // 4)
    if len(chunks) < 8 or size < 1024:
        return b"".join(chunks)[-DICTIONARY_BYTES:]
    try:
        return zstandard.train_dictionary(size, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-size:]


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Dictionaries and curve from at most ``4 * sample_rows`` labelled rows, chosen by hash.

    ``learn`` says which ids may be learnt from (all, if not given). Of several texts under one id the smallest
    counts, so the model doesn't follow the order of the rows. With labels of one class only, the score
    is the share of that class for every text.
    """
    known = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(learn if learn is not None else F.lit(True)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = dict(known.groupBy("quality").count().collect())
    total = sum(n.values())
    share = n.get(1, 0) / total if total else 0.5
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample_rows) for q in (0, 1)]
    chosen = chosen[0].unionAll(chosen[1])
    rows = texts_of(docs).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality")).collect()  # sample_rows
    rows.sort(key=lambda r: (hash_of(r.doc_id), r.doc_id))
    dicts, rest = {}, []
    for q in (0, 1):
        own = [r.text for r in rows if r.quality == q]
        half = (len(own) + 1) // 2
        dicts[q] = dictionary(own[:half])
        rest += [(t, q) for t in own[half:] or own]
    model = Model(dicts[1], dicts[0], np.zeros(6))
    y = np.array([q for _, q in rest])
    if len(set(y.tolist())) < 2:
        p = min(max(share, 1e-3), 1 - 1e-3)
        model.weights[-1] = math.log(p / (1 - p))
        return model
    features = model.scorer()
    model.weights = fit_curve(np.array([features(t) for t, _ in rest]), y, share)
    return model


def hash_of(doc_id: int) -> int:
    """Spreads ids, so that the halves of the sample don't follow the order of the table."""
    return (doc_id * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64) >> 20


def score_texts(texts: DataFrame, model: Model) -> DataFrame:
    """Replace the column ``text`` by ``score`` (0 to 1); the other columns stay."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = texts.drop("text")
    schema = rest.withColumn("score", F.lit(0.0)).schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = model.scorer()
        for b in batches:
            x = np.array([features(t.as_py() or "") for t in b.column("text")])
            p = logistic(x @ model.weights[:-1] + model.weights[-1]) if len(x) else np.zeros(0)
            own = [b.column(c) for c in target.names[:-1]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(p, pa.float64())], schema=target)

    return texts.mapInArrow(released(run), schema)


FOLDS = 5
KEEP_FROM = 0.3


def learnable() -> Column:
    return crc_of("doc_id") % FOLDS != 0


def predict(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null texts count as empty and get a score; repeated rows come back as often; labels for
    missing documents, null labels and empty tables are allowed (no labels: 0.5 for all); of
    several labels of a document the lower counts; further columns are not read.
    """
    model = train(docs, labels, learnable(), sample_rows)
    out = score_texts(texts_of(docs), model)
    return out.select(
        "doc_id",
        (~learnable()).alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their own columns.

    Null texts count as empty and get a score; null ids and repeated rows are judged like others; an empty table
    gives no rows, and without labels every document stays.
    """
    model = train(docs, labels, learnable())
    own = [docs[c].alias(f"own{i}") for i, c in enumerate(docs.columns)]
    out = score_texts(docs.select(*own, F.coalesce(docs["text"], F.lit("")).alias("text")), model)
    return out.where(F.col("score") >= KEEP_FROM).select(*[F.col(f"own{i}").alias(c) for i, c in enumerate(docs.columns)])
