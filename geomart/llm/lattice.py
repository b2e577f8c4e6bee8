"""Document likelihood over all subword segmentations.

The pieces of an existing vocabulary are the words of a unigram model. A document is a
sequence of words, each led by the word mark, and an end. Its probability is the sum over
all ways to cut it into pieces. Pieces never cross a space, so the sum is a product over words
and the forward recursion (in log space) runs once per distinct word, for many words at a
time. The vocabulary's own scores weigh the pieces at first; one expectation step over all
training words turns them into frequencies of this corpus.

Spark counts words per bucket of documents, sums them over the corpus, scores each distinct
word once, sends every bucket the words it holds, and adds up. What moves is distinct words,
and the texts once per pass.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import arrow_schema, crc_of, in_buckets, texts_of, words_of
from geomart.session import materialize

MARK = "▁".encode()
#: Key of the end of a document among the words; no word is empty.
END = ""
BASE = np.uint64(0x9E3779B97F4A7C15)
WORDS_AT_ONCE = 20_000
CELLS_AT_ONCE = 400_000


@dataclass
class Pieces:
    """Vocabulary pieces as bytes with their log weights, and hashes to find them."""

    texts: list[bytes]
    log_weight: np.ndarray

    def __post_init__(self):
        self.lengths = sorted({len(t) for t in self.texts})
        h = [prefix_hash(np.frombuffer(t, np.uint8)[None, :])[0, -1] for t in self.texts]
        keys = np.array(h, np.uint64) ^ spread(np.array([len(t) for t in self.texts]))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the piece with each key, or -1."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


def spread(length: np.ndarray | int) -> np.ndarray:
    return np.asarray(length, np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def prefix_hash(rows: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes (none to all) of byte rows of one width."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + rows[:, i] + np.uint64(1)
    return out


def load_pieces(model_path: str) -> Pieces:
    """Pieces of a sentencepiece file. Its scores are places in the order of merges, so a weight
    falls with the place as word frequencies do (1 / place); single bytes come after all pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts, place = [], []
    n = model.get_piece_size()
    seen = set()
    for i in range(n):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        t = bytes((int(model.id_to_piece(i)[3:5], 16),)) if model.is_byte(i) else model.id_to_piece(i).encode()
        if t not in seen:
            seen.add(t)
            texts.append(t)
            place.append(n if model.is_byte(i) else 2 - model.get_score(i))
    w = -np.log(np.array(place, float))
    return Pieces(texts, w - np.logaddexp.reduce(w))


def by_width(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Marked words of the same length as byte rows, with their places."""
    sizes: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        sizes.setdefault(len(w), []).append(i)
    for size, at in sizes.items():
        step = max(1, min(WORDS_AT_ONCE, CELLS_AT_ONCE // (size + 3)))
        for k in range(0, len(at), step):
            part = at[k : k + step]
            raw = np.frombuffer(b"".join([MARK + words[i] for i in part]), np.uint8)
            yield part, raw.reshape(len(part), size + 3)


def lattice(rows: np.ndarray, pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray]]:
    """Arcs of many words of one length: begin, end, and the piece of each word there or -1."""
    prefix = prefix_hash(rows)
    power = {n: np.uint64(pow(int(BASE), n, 1 << 64)) for n in pieces.lengths}
    for end in range(1, rows.shape[1] + 1):
        for n in pieces.lengths:
            if n > end:
                break
            key = prefix[:, end] - prefix[:, end - n] * power[n]
            found = pieces.find(key ^ spread(n))
            if (found >= 0).any():
                yield end - n, end, found


def forward(arcs: Iterator[tuple[int, int, np.ndarray]], n: int, width: int, weight: np.ndarray) -> np.ndarray:
    """Log probability of every prefix of every word, (width + 1, n)."""
    alpha = np.full((width + 1, n), -np.inf)
    alpha[0] = 0
    for begin, end, piece in arcs:
        np.logaddexp(alpha[end], alpha[begin] + np.where(piece >= 0, weight[piece], -np.inf), out=alpha[end])
    return alpha


def word_scores(words: list[bytes], pieces: Pieces, weight: np.ndarray) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word."""
    out = np.empty(len(words))
    for at, rows in by_width(words):
        out[at] = forward(lattice(rows, pieces), len(at), rows.shape[1], weight)[-1]
    return out


def expected_counts(words: list[bytes], times: np.ndarray, pieces: Pieces) -> np.ndarray:
    """How often each piece is used, over all segmentations by their probability."""
    total = np.zeros(len(pieces.texts))
    weight = pieces.log_weight
    for at, rows in by_width(words):
        width = rows.shape[1]
        arcs = [(b, e, p.astype(np.int32)) for b, e, p in lattice(rows, pieces)]
        alpha = forward(iter(arcs), len(at), width, weight)
        beta = np.full_like(alpha, -np.inf)
        beta[width] = 0
        for begin, end, piece in reversed(arcs):
            good = piece >= 0
            w = np.where(good, weight[piece], -np.inf)
            share = np.exp(alpha[begin] + w + beta[end] - alpha[width]) * times[at]
            total += np.bincount(piece[good], share[good], len(total))
            np.logaddexp(beta[begin], w + beta[end], out=beta[begin])
    return total


def score(
    docs: DataFrame, model_path: str, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Base and lattice log10 probabilities of every document.

    Learns from documents whose crc32 of the id, modulo ``folds``, is not ``held_out``. A null
    text is empty and has only its end; a null id counts as the empty text in the fold;
    repeated rows count and come back as often; an empty table gives no rows; further
    columns are not read. Words of any length are scored whole.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col).withColumn("held_out", crc_of("doc_id") % folds == held_out)
    texts = in_buckets(texts)
    spec = "bucket int, word string, n long"
    target = arrow_schema(docs, spec)

    def count(group: pa.Table) -> pa.Table:
        seen: Counter[bytes] = Counter()
        train: Counter[bytes] = Counter()
        ends = 0
        for text, out in zip(group.column("text"), group.column("held_out").to_pylist()):
            (seen if out else train).update(words_of(text.as_py()))
            ends += not out
        words = list(train.keys() | seen.keys())
        return pa.table(
            {
                "bucket": [group.column("bucket")[0].as_py()] * (len(words) + 1),
                "word": [w.decode() for w in words] + [END],
                "n": [train.get(w, 0) for w in words] + [ends],
            },
            schema=target,
        )

    # (bucket, word) pairs: the distinct words of each bucket
    held = materialize(texts.groupBy("bucket").applyInArrow(count, spec), "lattice-held")
    words = held.groupBy("word").agg(F.sum("n").alias("c"))
    words = materialize(words, "lattice-words")
    totals = words.where("c > 0").agg(F.sum("c"), F.count("c")).first()
    n_all, v_all = totals[0] or 0, totals[1] or 0
    ends = words.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0

    used_schema = "piece int, n double"
    used_target = arrow_schema(docs, used_schema)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model_path)
        total = np.zeros(len(pieces.texts))
        for b in batches:
            listed = [w.encode() for w in b.column("word").to_pylist()]
            total += expected_counts(listed, np.array(b.column("c").to_pylist(), float), pieces)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": at, "n": total[at]}, schema=used_target)

    train = words.where((F.col("c") > 0) & (F.col("word") != END))
    used = train.mapInArrow(expect, used_schema).groupBy("piece").agg(F.sum("n").alias("n")).collect()  # the vocabulary at most
    pieces = load_pieces(model_path)
    n = np.full(len(pieces.texts), 0.5)  # a piece never used keeps a little weight, so every text has a probability
    for r in used:
        n[r.piece] += r.n
    weight = np.log(n / (n.sum() + ends + 0.5))
    end_log10 = math.log10((ends + 0.5) / (n.sum() + ends + 0.5))

    scored_schema = "word string, c long, logp double"
    scored_target = arrow_schema(docs, scored_schema)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model_path)
        for b in batches:
            listed = [w.encode() for w in b.column("word").to_pylist()]
            logp = word_scores(listed, pieces, weight) / math.log(10)
            logp = np.where([not w for w in listed], end_log10, logp)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(logp)], schema=scored_target)

    scored = words.select("word", "c").mapInArrow(weigh, scored_schema)
    tables = held.select("bucket", "word").join(scored, "word")

    spec_out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    target_out = arrow_schema(docs, spec_out)

    def add_up(group: pa.Table, table: pa.Table) -> pa.Table:
        number = {w.encode(): i for i, w in enumerate(table.column("word").to_pylist())}
        c = table.column("c").to_numpy()
        base = np.log10((c + 1) / (n_all + v_all + 1))
        logp = table.column("logp").to_numpy()
        get = number.__getitem__
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for text in group.column("text"):
            at = np.fromiter(map(get, [*words_of(text.as_py()), b""]), np.int64)
            out["n_tokens"].append(len(at))
            out["n_known"].append(int((c[at] > 0).sum()))
            out["base_score"].append(float(base[at].sum()))
            out["score"].append(float(logp[at].sum()))
        own = {"doc_id": group.column("doc_id"), "held_out": group.column("held_out"), "train_tokens": [n_all] * len(group)}
        return pa.table({k: (own | out)[k] for k in target_out.names}, schema=target_out)

    return texts.groupBy("bucket").cogroup(tables.groupBy("bucket")).applyInArrow(add_up, spec_out)
