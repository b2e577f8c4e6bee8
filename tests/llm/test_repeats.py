from __future__ import annotations

import hashlib

import numpy as np
import pytest

from geomart.llm import repeats as R


def brute(texts):
    first: dict[bytes, int] = {}
    named = sorted(((i, t.encode()) for i, t in texts if i is not None), key=lambda r: r[0])
    out = []
    for i, b in named:
        hit = bytearray(len(b))
        for a in range(len(b) - 49):
            if first.setdefault(b[a : a + 50], i) < i:
                hit[a : a + 50] = b"\x01" * 50
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        out.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [16 << 20, 60_000])
def test_removed_bytes_equal_brute_force(docs, texts, bucket):
    got = [tuple(r) for r in R.summary(docs, bucket_bytes=bucket).collect()]
    assert len(got) == len(texts)
    assert sorted(r for r in got if r[0] is not None) == sorted(brute(texts))
    assert all(r[2] == 0 for r in got if r[0] is None)


def test_columns_give_suffix_order():
    r = np.random.default_rng(3)
    rows = ["".join(r.choice(list("ab"), r.integers(50, 84))).encode() for _ in range(30)]
    size = np.array([len(x) for x in rows])
    grid = np.array([list(x.ljust(R.WIDTH, b"\0")) for x in rows], np.uint8)
    order, begin = R.column_order(grid, size)
    row = np.searchsorted(begin, order, "right") - 1
    suffixes = [rows[k][o - begin[k] :] for k, o in zip(row.tolist(), order.tolist())]
    assert suffixes == sorted(suffixes) and len(suffixes) == size.sum() + len(rows)


def test_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(R, "PART_BYTES", 300)
    text = bytes(np.random.default_rng(1).integers(97, 123, 2000).astype(np.uint8))
    seen = []
    for _, doc, first, shift, strings, _ in R.pieces_of([text, b"short", text[:60]]):
        for d, a, n in zip(doc.tolist(), (first + shift).tolist(), strings.tolist()):
            seen += [(d, a + k) for k in range(n)]
    assert sorted(seen) == [(0, k) for k in range(1951)] + [(2, k) for k in range(11)]


def test_ranges(spark):
    a = "".join(chr(97 + i * i % 26) for i in range(200))
    df = spark.createDataFrame([(1, a), (2, "#" + a[20:120] + "!"), (3, "z")], "doc_id long, text string")
    rows = {r.doc_id: r for r in R.ranges(df).collect()}
    assert [tuple(x) for x in rows[2].removed] == [(1, 101)] and bytes(rows[2].kept) == b"#!"
    assert rows[1].removed == [] and R.summary(df.where("false")).count() == 0


def smallest(pieces, least):
    """By a table of all strings."""
    low = {}
    for p, i in zip(pieces, least):
        for a in range(len(p) - 49):
            low[p[a : a + 50]] = min(i, low.get(p[a : a + 50], i))
    return [low[p[a : a + 50]] for p in pieces for a in range(len(p) - 49)]


def as_rows(pieces):
    grid = np.array([list(p.ljust(R.WIDTH, b"\0")) + [len(p)] for p in pieces], np.uint8)
    return np.frombuffer(grid.tobytes(), f"S{R.WIDTH + 1}")


@pytest.mark.parametrize("letters", [2, 26])
def test_one_seed_in_many_contexts(letters):
    r = np.random.default_rng(letters)
    make = lambda n: (97 + r.integers(0, letters, n)).astype(np.uint8).tobytes()
    base = [make(34) + b"0123456789abcdef" + make(34) for _ in range(300)]
    pieces = [p[a : a + r.integers(50, 85 - a)] for p in base for a in r.integers(0, 20, 3).tolist()] + [b"a" * 84, b"a" * 60]
    pieces = sorted(set(pieces))
    least = r.integers(0, 1000, len(pieces))
    low, offset = R.smallest_ids(as_rows(pieces), least, np.zeros(len(pieces), np.uint32))
    assert low.tolist() == smallest(pieces, least.tolist())
    assert offset.tolist() == np.cumsum([0] + [len(p) - 49 for p in pieces])[:-1].tolist()


def test_a_seed_in_100_000_contexts_is_not_put_in_order(monkeypatch):
    """All pieces differ in every string but for a few that are shared; only these are put in order."""
    r = np.random.default_rng(1)
    n = 100_000
    grid = r.integers(97, 123, (n, R.WIDTH + 1)).astype(np.uint8)
    grid[:, 34:50] = np.frombuffer(b"0123456789abcdef", np.uint8)
    grid[n // 2 : n // 2 + 50, :60] = grid[:50, :60]
    grid[:, 60], grid[n // 2 : n // 2 + 50, 60] = 97, 98
    grid[:, R.WIDTH] = R.WIDTH
    ordered = []
    real = R.compared
    monkeypatch.setattr(R, "compared", lambda g, x: (ordered.append(len(g)), real(g, x))[1])
    low, offset = R.smallest_ids(np.frombuffer(grid.tobytes(), f"S{R.WIDTH + 1}"), np.arange(n), np.zeros(n, np.uint32))
    assert sum(ordered) == 100
    low = low.reshape(n, R.SPAN)
    want = np.repeat(np.arange(n)[:, None], R.SPAN, 1)
    want[n // 2 : n // 2 + 50, :11] = np.arange(50)[:, None]
    assert (low == want).all()
