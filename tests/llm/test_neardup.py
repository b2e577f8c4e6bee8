from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from geomart.llm import neardup as N
from geomart.llm.shingles import WordHashes, shingle_set, signature

from .conftest import lower


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        if i is not None:
            out[i] = s
    return out


def brute(sets):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    for d, s in sets.items():
        both = defaultdict(int)
        for x in s:
            for e in holders[x]:
                both[e] += 1
        for e, k in both.items():
            if e > d and 100 * k >= 75 * (len(s) + len(sets[e]) - k):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize("block", [8, 1024])
def test_components_equal_brute_force(docs, texts, block):
    want = brute(sets_of(texts))
    rows = N.cluster(docs, block=block).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in rows if r.doc_id is not None} == want
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)


def test_pigeonhole_finds_every_pair_within_the_distance():
    r = np.random.default_rng(5)
    a = r.integers(0, 1 << 16, (300, 64)).astype("<u2")
    b = a.copy()
    for row in b:
        at = r.choice(64, r.integers(0, N.MAX_DISTANCE + 1), replace=False)
        row[at] ^= 1
    assert (N.keys_of(a) == N.keys_of(b)).any(1).all()
    assert N.distance_ok(a, b).all()


def test_signature_distance_tells_similarity():
    words = [f"w{i}" for i in range(2000)]
    hashes = WordHashes()
    a, b = (shingle_set(" ".join(w), hashes) for w in (words, words[:1715]))  # similarity about 0.857
    differ = (signature(a) != signature(b)).sum()
    assert 2 <= differ <= 20


def test_components_of_chains_and_earlier_labels(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in N.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}
    more = N.components(spark.createDataFrame([(40, 101)], "a long, b long"), N.components(edges))
    assert {r.label for r in more.collect()} == {1}


def test_one_of_each_group_stays(docs, texts):
    kept = N.keep_one(docs)
    want = {d for d, v in brute(sets_of(texts)).items() if v[2]}
    rows = kept.select("doc_id").collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in rows) == 2 and kept.columns == docs.columns
    assert N.cluster(docs.where("false")).count() == 0
