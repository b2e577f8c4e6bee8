from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from geomart.llm import lattice as L
from geomart.llm.common import words_of

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word: bytes, weight: dict[bytes, float]) -> list[list[bytes]]:
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if word[:k] in weight for rest in all_segmentations(word[k:], weight)]


def test_recursion_sums_all_segmentations():
    texts = [b"a", b"b", b"ab", b"ba", b"aba", "▁".encode(), "▁a".encode(), b"\xe2", b"\x96", b"\x81"]
    w = np.log(np.arange(1, 11) / 55)
    pieces = L.Pieces(texts, w)
    table = dict(zip(texts, w.tolist()))
    words = [b"a", b"abab", b"bb", b"abaab", b"c"]
    got = L.word_scores(words, pieces, w)
    counts = np.zeros(10)
    for word, times, g in zip(words[:4], (1, 2, 3, 4), got):
        ways = [(math.exp(sum(table[p] for p in way)), way) for way in all_segmentations(L.MARK + word, table)]
        total = sum(p for p, _ in ways)
        assert math.isclose(math.exp(g), total, rel_tol=1e-9)
        for p, way in ways:
            for piece in way:
                counts[texts.index(piece)] += times * p / total
    assert got[4] == -math.inf
    assert np.allclose(L.expected_counts(words[:4], np.array([1.0, 2, 3, 4]), pieces), counts)


def test_scores(docs, texts):
    rows = L.score(docs, PATH).collect()
    assert len(rows) == len(texts)
    train: Counter = Counter()

    def held(i):
        return zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2

    for i, t in texts:
        if not held(i):
            train.update([*words_of(t), b""])
    n, v = sum(train.values()), len(train)
    want = {}
    for i, t in texts:
        tokens = [*words_of(t), b""]
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens)
        want.setdefault(i, []).append((held(i), len(tokens), sum(train[w] > 0 for w in tokens), n, round(base, 6)))
    got: dict = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert math.isfinite(r.score) and r.score < 0
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}


def test_shuffled_letters_are_less_likely(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    r = L.score(docs.unionAll(spark.createDataFrame([(10**6 + 1, "the of and thing")], "doc_id long, text string")), PATH)
    a = r.where("doc_id = 1000001").first().score
    r = L.score(docs.unionAll(spark.createDataFrame([(10**6 + 1, "hte fo dna gniht")], "doc_id long, text string")), PATH)
    assert a > r.where("doc_id = 1000001").first().score


def test_empty_table(docs):
    assert L.score(docs.where("false"), PATH).count() == 0
    assert pytest.approx(L.score(docs.where("doc_id = 20000"), PATH).first().n_tokens) == 1
