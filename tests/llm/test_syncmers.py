from __future__ import annotations

import hashlib
from collections import defaultdict

from geomart.llm import syncmers as Y


def test_edited_texts_and_neighbours(docs, texts):
    smallest = {}
    for i, t in texts:
        if i is not None:
            smallest[i] = min(smallest.get(i, t), t)
    ids = sorted(smallest, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    want, got = defaultdict(list), defaultdict(list)
    for i, t in texts:
        half = len(t) // 2
        edited = t[: len(t) - half] + (smallest[following[i]][:half] if i is not None else "")
        want[i].append((len(t), hashlib.sha256(edited.encode()).hexdigest()))
    prints = {}
    for r in Y.fingerprints(docs).collect():
        got[r.doc_id].append((r.n_chars, r.edited_sha256))
        assert 0 <= r.near_edited <= 1 and (r.near_next is None) == (r.doc_id is None)
        prints[r.doc_id] = r
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert prints[20004].fingerprint == prints[20006].fingerprint != ""
    assert prints[20000].fingerprint == ""


def test_anchors_are_closed_syncmers(spark):
    """Chosen k-mers do not depend on what stands around them."""
    words = [f"w{i * 7919 % 1000}" for i in range(200)]
    df = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(["new"] * 9 + words[50:150] + ["end"] * 9)), (2, " ".join(words[:60]))], "i int, text string")
    a = {r.i: r.a for r in Y.with_anchors(df, "text", "a").collect()}
    assert 0.35 * 196 < len(a[0]) < 0.65 * 196 and a[0] == sorted(set(a[0]))
    assert len(set(a[0]) & set(a[1])) > 30  # about half of the 96 k-mers inside the common part
    assert set(a[2]) <= set(a[0])


def test_likeness_follows_the_common_part(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    rows = [(0, " ".join(words), " ".join(words)), (1, " ".join(words[:200]), " ".join(words)), (2, " ".join(words), " ".join(f"v{i}" for i in range(300)))]
    df = spark.createDataFrame(rows, "i int, x string, y string")
    df = Y.with_anchors(Y.with_anchors(df, "x", "a"), "y", "b").select("i", Y.likeness("a", "b").alias("s"))
    s = {r.i: r.s for r in df.collect()}
    assert s[0] == 1 and 0.35 < s[1] < 0.65 and s[2] == 0


def test_plan_has_no_python_and_shuffles_texts_once(spark, docs):
    df = Y.fingerprints(docs)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.where("false").count() == 0 and Y.fingerprints(docs.where("false")).count() == 0
    assert Y.fingerprints(docs.where("doc_id = 20002")).count() == 1


def test_long_texts_keep_every_anchor(spark):
    """Two long texts that share a short passage share all anchors inside it."""
    shared = [f"s{i}" for i in range(300)]
    a, b = ([f"{c}{i}" for i in range(8000)] for c in "ab")
    rows = [(1, " ".join(a[:4000] + shared + a[4000:])), (2, " ".join(b[:1000] + shared + b[1000:])), (3, " ".join(shared))]
    prints = {r.doc_id: r for r in Y.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {r.fingerprint[j : j + 8] for j in range(0, len(r.fingerprint), 8)} for i, r in prints.items()}
    assert 0.45 * 8296 < len(sets[1]) < 0.55 * 8296 and 0.45 * 296 < len(sets[3]) < 0.55 * 296
    assert sets[3] <= sets[1] and sets[3] <= sets[2]
    assert prints[2].near_next == len(sets[1] & sets[2]) / len(sets[1] | sets[2]) > 0


def test_places_locate_shared_passages(spark):
    """Paragraphs in another order share anchors at one offset each; places are those of a brute force."""
    one, two = ([f"{c}{i}" for i in range(60)] for c in "pq")
    rows = [(1, " ".join(one + two)), (2, " ".join(two + ["new"] * 7 + one)), (3, "a b"), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.doc_id: r for r in Y.fingerprints(docs).collect()}
    assert [p.at for p in prints[3].places] == [0] and [p.hash for p in prints[None].places] == [prints[3].places[0].hash]
    at = [p.at for p in prints[1].places]
    assert at == sorted(set(at)) and max(at) <= 115
    places = {i: [(p.hash, p.at) for p in prints[i].places] for i in (1, 2)}
    want = {}
    for h, x in places[1]:
        for g, y in places[2]:
            if h == g:
                want.setdefault(y - x, []).append(x)
    assert set(want) == {-60, 67} and all(len(w) > 15 for w in want.values())
    got = Y.passages(docs.where("doc_id = 1"), docs.where("doc_id = 2")).collect()
    assert {(r.left_id, r.right_id, r.offset, r.n, r["first"], r["last"]) for r in got} == {(1, 2, o, len(w), min(w), max(w)) for o, w in want.items()}


def test_anchors_of_unspaced_runs_do_not_depend_on_their_beginning(spark):
    """One character more at the front of an unspaced run leaves the anchors after it, one place on."""
    run = "".join(chr(0x4E00 + i * i * 7919 % 5000) for i in range(600))
    rows = [(0, run), (1, run[:3] + "\u4e8c" + run[3:]), (2, "a b " + run[100:400] + " c"), (3, "x" * 24 + " " + "y" * 25)]
    df = Y.with_places(spark.createDataFrame(rows, "i int, text string"), "text", "p")
    p = {r.i: {(x.hash, x.at) for x in r.p} for r in df.collect()}
    assert len(p[0]) > 0.35 * 596 and len([x for x in p[0] if x[1] > 3]) == len(p[0] & {(h, at - 1) for h, at in p[1]} - {x for x in p[0] if x[1] <= 3})
    inside = {h for h, at in p[2] if 2 <= at < 2 + 300 - 12}
    assert len(inside) > 100 and inside <= {h for h, _ in p[0]}
    symbols = spark.createDataFrame(rows[3:], "i int, text string").selectExpr(f"regexp_extract_all(text, r'{Y.WORD}', 1) AS s").first().s
    assert symbols[0] == "x" * 24 and symbols[1:] == ["y" * min(8, 25 - i) for i in range(25)]
