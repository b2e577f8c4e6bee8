from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from geomart.llm import warc as W

ROWS = [
    (5, "http://a", "x" * 200),
    (3, "http://b c\r\nd", "x" * 200),
    (3, "http://twin", "x" * 200),
    (9, None, "x" * 200),
    (1, "http://s", "short"),
    (2, "http://s", "short"),
    (4, "http://n", None),
    (6, "http://e", ""),
    (7, "http://u", "é€😀" * 40),
    (8, "http://u", "é€😀" * 40),
    (None, None, "x" * 200),
    (10, "http://long", "<p>\r\n\r\nWARC/1.1\r\n" * 60_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "other") for r in ROWS], "page_id long, url string, html string, digest string")


def test_round_trip(pages, tmp_path):
    got = sorted((tuple(r)[:1] + tuple(r)[2:] for r in W.round_trip(pages, str(tmp_path)).collect()), key=str)
    firsts = {}
    for page, _, html in ROWS:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            firsts[raw] = min(page, firsts.get(raw, page))
    want = []
    for page, _, html in ROWS:
        raw = (html or "").encode()
        first = firsts.get(raw)
        ref = first if first is not None and first != page else None
        if page is None:
            ref = first
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if ref is not None else "response", ref))
    assert got == sorted(want, key=str)


def test_archives_are_ordinary_gzip_members(pages, tmp_path):
    paths = W.write(pages, str(tmp_path))
    raw = b"".join(gzip.decompress(open(p, "rb").read()) for p in paths)
    assert raw.count(b"WARC/1.1\r\nWARC-Type:") == len(ROWS)
    assert b"http://b%20c%0D%0Ad" in raw


def test_damage_is_seen():
    good = W.record(1, "u", b"abc" * 50, hashlib.sha256(b"abc" * 50).hexdigest(), None)
    assert W.parse(good)[0]["WARC-Type"] == "response"
    for bad in (good.replace(b"abcabc", b"abdabc", 1), good[:-1], good + b"x", b"NO" + good):
        with pytest.raises(W.BadRecord):
            W.parse(bad)
    packed = W.member(good)
    assert list(W.members(io.BytesIO(packed * 3))) == [good] * 3
    with pytest.raises(W.BadRecord):
        list(W.members(io.BytesIO(packed + packed[: len(packed) // 2])))


def test_empty_table(pages, tmp_path):
    assert W.round_trip(pages.where("false"), str(tmp_path)).count() == 0
