from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from geomart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_ids_equal_the_library(docs, texts):
    lib = library()
    want = []
    for i, t in texts:
        ids = np.array(lib.encode_ordinary(t), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_random_signs():
    r, lib, own = random.Random(1), library(), bpe.Encoder(PATH, public_tokenizers.PATTERN)
    texts = ["".join(r.choice(" \n\t\x1c\x85　 aabbcthe'sréüß中文1234567890.,!?-_😀́") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    for t, raw in zip(texts, own.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == lib.encode_ordinary(t), repr(t)
        assert own.decode(raw) == t.encode()


def test_replay_of_a_vocabulary_out_of_order(tmp_path):
    """A lower rank that comes up late, overlapping pairs, and two ways to one token."""
    ranks = {bytes((c,)): c for c in range(256)}
    for i, t in enumerate([b"abc", b"ab", b"aa", b"aaa", b"bc", b"abab", b"cab"]):
        ranks[t] = 256 + i
    path = tmp_path / "r"
    import base64

    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
    lib = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(2)
    pieces = list({"".join(r.choice("abc") for _ in range(r.randint(1, 14))) for _ in range(600)})
    got = bpe.replay([p.encode() for p in pieces], ranks, bpe.pair_table(str(path)))
    for p, raw in zip(pieces, got):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == lib.encode_ordinary(p), p
        assert ids == bpe.merge_alone(p.encode(), ranks)


def test_columns_are_carried(docs):
    out = bpe.with_ids(docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == [c for c in docs.columns if c != "text"] + ["n_tokens", "ids"]
    assert out.count() == docs.count() and bpe.digests(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_clashing_names_are_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, "ab", "x", "y", 5), (None, None, None, None, None)], "doc_id long, text string, ids string, N_TOKENS string, own0 int")
    out = bpe.with_ids(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "own0", "n_tokens", "ids"]
    out.write.parquet(str(tmp_path / "o"))
    assert sorted(spark.read.parquet(str(tmp_path / "o")).select("own0", "n_tokens").collect(), key=str) == [(5, 1), (None, 0)]
