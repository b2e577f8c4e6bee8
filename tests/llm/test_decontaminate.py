from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from geomart.llm import decontaminate as D

from .conftest import SMALL, lower


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


@pytest.fixture(scope="module")
def items(spark):
    own = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    more = [(9001, "cat dog"), (9002, ""), (9003, None), (9004, "a"), (9005, "a b"), (9005, "ab ab"), (None, "a b c"), (9006, "ab " * 13)]
    return own.unionByName(spark.createDataFrame(more, "item_id long, text string"))


def brute(texts, items):
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        for k in [tuple(w[a : a + 13]) for a in range(len(w) - 12)] or [tuple(w)]:
            windows.setdefault(k, set()).add(i)
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                if (k := tuple(w[a : a + size])) in windows:
                    hit |= set(range(a, a + size))
                    found |= windows[k]
        listed = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [4 << 20, 700])
def test_flags_equal_brute_force(docs, texts, items, block):
    want = brute(texts, [tuple(r) for r in items.select("item_id", "text").collect()])
    got = D.flag(docs, items, block_bytes=block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


def test_matches_are_maximal(spark):
    item = [f"i{k}" for k in range(40)]
    doc = ["x", "y", *item[5:35], "z", *item[:13]]
    docs = spark.createDataFrame([(1, " ".join(doc), 3)], "doc_id long, text string, matches int")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    m = np.frombuffer(D.find_matches(docs, items).first().matches, D.MATCH)
    assert sorted(m.tolist()) == [(7, 0, 33, 13), (7, 5, 2, 30)]
    assert D.covered(m) == 43


def test_removal_keeps_columns(docs, items):
    out = D.decontaminate(docs, items)
    clean = D.flag(docs, items).where("NOT contaminated").count()
    assert out.columns == docs.columns and out.count() == clean
    assert D.flag(docs.where("false"), items).count() == 0
    assert D.flag(docs, items.where("false")).where("n_hit > 0").count() == 0
