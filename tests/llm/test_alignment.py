from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from geomart.llm import alignment as K

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(text, libraries):
    """Groups of (A ids, B ids), by walking along the bytes; None without tokens."""
    a, b = libraries
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    signs = K.byte_signs()
    bytes_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    out, own, x, y, i, j = [], ([], []), 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if x <= y:
            x += len(bytes_a[i])
            own[0].append(ids_a[i])
            i += 1
        else:
            y += len(bytes_b[j])
            own[1].append(ids_b[j])
            j += 1
        if x == y:
            out.append(own)
            own = ([], [])
    return out


def expected(rows, libraries):
    every = [(i, groups_of(t, libraries)) for i, t in rows]
    links = [Counter((x, y) for g in gs or [] for x in g[0] for y in g[1]) for _, gs in every]
    held = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (i, gs), c in zip(every, links):
        gs = gs or []
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append(
            (
                i,
                sum(len(x) for x, _ in gs),
                sum(len(y) for _, y in gs),
                len(gs),
                sum(c.values()),
                sum(n for p, n in c.items() if held[p] == most[p[0]]),
                sum(n * held[p] for p, n in c.items()),
                hashlib.sha256(shown.encode()).hexdigest() if gs else "",
            )
        )
    return sorted(out, key=str)


SIGNS = " \n\t\r\x1c\x85\xa0　aabbcthe'sréüß中文1234567890.,!?-_😀́▁{};)(<>|"


def odd(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(SIGNS) for _ in range(r.randint(0, 60))) for _ in range(n)]


MORE = ["▁", "a▁b c", "x" * 3000, "<s> </s> <unk> <0x41> <|endoftext|>", " ", "  ", "\n", " a", "a ", "a \n ", "ü" * 400, "\x00", ");\r\n x ;\r", "中文" * 300]


def test_equals_brute_force(spark, docs, texts, libraries):
    more = list(enumerate(MORE + odd(300, 5), 70_000))
    extra = spark.createDataFrame(more, "doc_id long, text string")
    rows = [(i, t) for i, t in [*texts, *more] if len(t) < 30_000]
    every = docs.select("doc_id", "text").unionAll(extra).where("text IS NULL OR length(text) < 30000")
    got = K.summary(every, A, B).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, libraries)


def test_long_texts_in_parts_and_small_buckets(spark, texts, libraries, monkeypatch):
    rows = [(i, t) for i, t in texts if t and len(t) < 8_000][:40] + [(1, " ".join(odd(60, 6))), (2, "a▁ " + "b " * 900), (3, "b " * 900), (3, "b " * 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows, libraries)
    assert sorted(map(tuple, K.summary(df, A, B, slice_chars=500).collect()), key=str) == want
    v = K.aligner(A, B)
    monkeypatch.setattr(K, "CACHE_STRETCHES", 10)
    for limit in (1, 7, 100):
        for _, t in rows[:20]:
            assert "".join(K.parts(" " + t, limit)) == " " + t
            (one, digest), gs = v.long_text(t, limit), groups_of(t, libraries)
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
            assert digest == hashlib.sha256(shown.encode()).hexdigest() and one["n_groups"][0].as_py() == len(gs)


def test_a_group_without_shared_ends_is_not_multiplied_out(libraries):
    text = "x" * 60_001
    t = K.aligner(A, B).texts([text])
    gs = groups_of(text, libraries)
    assert t["n_links"][0].as_py() == sum(len(x) * len(y) for x, y in gs)
    assert len(t["key"][0]) == len({(i, j) for x, y in gs for i in set(x) for j in set(y)}) < 100


def test_ranked_merges_equal_the_file(libraries):
    t = K.Tokenizers(A, B)
    assert t.ranked and t.cuttable
    for text in odd(300, 9):
        assert t.ranked.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids


def test_empty_and_clashing_columns(spark, docs):
    from pyspark.sql import functions as F

    assert K.summary(docs.where("false"), A, B).collect() == []
    few = docs.where("doc_id < 30").select("doc_id", "text", *[F.lit("x").alias(c) for c in ("bucket", "a", "b", "links", "n_a", "count", "best", "row")])
    assert K.summary(few, A, B).count() == few.count()
