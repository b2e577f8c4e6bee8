from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geomart.llm import frames as K

LINE = re.compile(r"[^\n]*\n|[^\n]+")
CODEC = K.Codec()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text: str):
    """By the contract, on the text itself."""
    h = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    lines = LINE.findall(text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def by_text(rows):
    return sorted(rows, key=str)


def test_round_trip_equals_brute_force(spark, docs, texts):
    r = random.Random(3)
    more = ["".join(r.choice(["\n", "a", "ü", "😀", "<", "P>", "<S", ">", "\r", "x" * 900]) for _ in range(r.randint(0, 200))) for _ in range(300)]
    more += ["x<P>", "<M>", "\n", "\n\n", "a\n" * 70_000, "a" * K.FRAME_CHARS, "a" * K.FRAME_CHARS + "\n", "ü" * 100_000 + "\nb"]
    extra = spark.createDataFrame(list(enumerate(more, 60_000)), "doc_id long, text string")
    every = docs.select("doc_id", "text").unionAll(extra)
    want = [expected(i, t) for i, t in [*texts, *enumerate(more, 60_000)]]
    got = K.round_trip(every).collect()
    assert by_text(map(tuple, got)) == by_text((*w[:5], sha(w[5]), sha(t)) for w, (_, t) in zip(want, [*texts, *enumerate(more, 60_000)]))
    turned = K.transform(K.store(every))
    assert by_text(map(tuple, K.texts(turned).collect())) == by_text((w[0], w[5]) for w in want)
    assert by_text(map(tuple, K.restored(turned).collect())) == by_text([*texts, *enumerate(more, 60_000)])
    assert K.round_trip(docs.where("false")).count() == 0


def test_other_rules(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    forms = {r.form for r in K.transform(K.store(df), K.Rule(turned=0)).collect()}
    assert forms == {"plain"}
    turned = K.transform(K.store(df), K.Rule(seed=11, turned=60, spm=0))
    assert {r.form for r in turned.collect()} == {"plain", "psm"}
    assert by_text(map(tuple, K.restored(turned).collect())) == by_text(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\nü<PSM>", max_size=60), st.integers(1, 7), st.data())
def test_frames_equal_the_text(text, size, data):
    cuts = sorted(data.draw(st.lists(st.integers(0, len(text)), max_size=4)))
    pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    f = K.Frames.of(pieces, CODEC, size)
    lines = LINE.findall(text)
    assert all(b - a == size for a, b in zip([0, *f.chars], f.chars[:-1]))
    assert "".join(f.whole(CODEC)) == text and f.n_chars == len(text) and f.n_units(CODEC) == len(lines)
    for k in range(len(lines) + 1):
        assert f.cut(k, CODEC) == len("".join(lines[:k]))
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(text)), st.integers(0, len(text)))))
    assert "".join(f.stream(a, b, CODEC)) == text[a:b]
    for mark in ("<P>", "<S>", "a\nü"):
        assert f.find(mark, a, CODEC) == text.find(mark, a)


def test_a_cut_unpacks_one_frame():
    class Counting(K.Codec):
        def __init__(self):
            super().__init__()
            self.n, inner = 0, self.unpack

            def unpack(raw):
                self.n += 1
                return inner(raw)

            self.unpack = unpack

    codec = Counting()
    f = K.Frames.of(["ab\n" * 100_000], codec)
    assert len(f.frames) > 5
    for unit in (1, 50_000, 99_999, 100_000):
        codec.n = 0
        assert f.cut(unit, codec) == 3 * unit and codec.n <= 1


@pytest.mark.parametrize("doc_id", [0, -5, None, 2**62])
def test_draws(doc_id):
    assert K.Rule().draws(doc_id) == [int(sha(f"7:{'' if doc_id is None else doc_id}")[i : i + 8], 16) for i in (0, 8, 16, 24)]
