from __future__ import annotations

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from geomart.llm import tokenfiles as K
from geomart.llm.rangecoder import decode_blocks, encode_blocks

PATH = public_tokenizers.path("word_bpe_49k.json")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_files_hold_what_the_library_gives(docs, texts, tmp_path):
    t, start, want = tokenizer(), 0, []
    tie = {r.text or "": r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    for i, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]], r[1])):
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = K.round_trip(docs, PATH, str(tmp_path), shard_bytes=100_000).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_words_equal_whole_texts():
    r, t, w = random.Random(4), tokenizer(), K.Words(PATH)
    texts = ["hello <|endoftext|> world", "a<|ENDOFTEXT|>B", "X<|startoftext|>,y <|endoftext|><|endoftext|>. Z", "ü<|endoftext|>É,"]
    texts += ["".join(r.choice(" \n\t\x1cab.,'sréÜß中1.!<|>_😀́K") for _ in range(70)) for _ in range(400)]
    for text, raw in zip(texts, w.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 49407), st.integers(0, 3)), max_size=400), st.integers(1, 60))
def test_coder_round_trip(ids, block):
    raw = np.array(ids, np.int64)
    payloads = encode_blocks(raw, block)
    sizes = [min(block, len(ids) - i) for i in range(0, len(ids), block)]
    assert len(payloads) == len(sizes)
    assert decode_blocks(payloads, sizes).tolist() == ids


def test_coder_adapts_and_blocks_are_independent():
    r = np.random.default_rng(2)
    ids = np.tile(r.integers(0, 49000, 40), 100)
    payloads = encode_blocks(ids, 1000)
    assert sum(map(len, payloads)) < 2 * len(ids) / 4  # against 2 bytes an id
    assert decode_blocks(payloads[2:3], [1000]).tolist() == ids[2000:3000].tolist()


def shard(docs):
    sink = io.BytesIO()
    w = K.Writer(sink)
    for i, ids in docs:
        w.add(i, np.array(ids, "<u4"))
    w.close()
    return sink.getvalue()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_shard_reads_back_and_shows_damage():
    own = [(None, [2]), (4, list(range(3000))), (4, [2]), (9, [])]
    raw = shard(own)
    assert [(i, x.tolist()) for i, x in K.read_shard(Source(raw))] == own
    for place in (1, 40, len(raw) - 3):
        bad = bytearray(raw)
        bad[place] ^= 255
        with pytest.raises(K.BadShard):
            list(K.read_shard(Source(bytes(bad))))


def test_empty_table(docs, tmp_path):
    assert K.round_trip(docs.where("false"), PATH, str(tmp_path)).count() == 0


def test_rows_without_an_id_are_dealt_to_many_shards(spark, tmp_path):
    df = spark.range(600).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('some words ', repeat('x y ', 200), id) AS text")
    shards = K.write(df, PATH, str(tmp_path), shard_bytes=50_000)
    assert len(shards) > 5
    rows = K.read(spark, shards).collect()
    assert len(rows) == 600 and sorted(r.start for r in rows)[0] == 0
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_ids_beyond_the_coder_are_refused():
    assert decode_blocks(encode_blocks(np.array([131_070, 0]), 4), [2]).tolist() == [131_070, 0]
    with pytest.raises(ValueError, match="131072"):
        encode_blocks(np.array([131_071, 131_072]), 4)


def test_many_new_words_take_few_calls():
    w, given = K.Words(PATH), []

    class Counting:
        def __init__(self, own):
            self.own = own

        def __getattr__(self, name):
            return getattr(self.own, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.own.encode_batch_fast(texts, **options)

    for name, own in list(vars(w).items()):
        if hasattr(own, "encode_batch_fast"):
            setattr(w, name, Counting(own))
    r, t = random.Random(5), tokenizer()
    texts = ["".join(r.choice("abcdefghij éß1.") for _ in range(300)) for _ in range(200)]
    for text, raw in zip(texts, w.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(set(" ".join(texts).split())) > 3000 and len(given) < 100


def test_words_with_marks_and_letters_beyond_ascii():
    r, t, w = random.Random(6), tokenizer(), K.Words(PATH)
    letters, marks = "aZéßÀàíÿ÷×ªµİΣ中é­9", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    some = ["".join(r.choices(letters, k=r.randint(0, 4)) + r.choices(marks, k=r.randint(0, 3))) for _ in range(3000)]
    texts = ["", "|", "a|", " ", "|| | </w> a</w>", "it's he'll' O'S", "<|endoftext|>.", "<|endoftext|"] + [" ".join(some[i : i + 9]) for i in range(0, 3000, 9)]
    for _ in range(2):  # the second time all are known
        for text, raw in zip(texts, w.encode(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
        w.encode(texts[:20])


def test_an_id_narrows_the_range_once(monkeypatch):
    from geomart.llm import rangecoder as R

    calls, settle = [], R.Encoder.settle
    monkeypatch.setattr(R.Encoder, "settle", lambda self: calls.append(1) or settle(self))
    ids = np.random.default_rng(3).integers(0, 49000, 20 * 64 + 5)
    payloads = R.encode_blocks(ids, 64)
    assert len(calls) == 64
    assert decode_blocks(payloads, [64] * 20 + [5]).tolist() == ids.tolist()
    assert decode_blocks(payloads[20:], [5]).tolist() == ids[-5:].tolist()


def test_long_blocks_of_all_magnitudes_and_damage():
    r = np.random.default_rng(4)
    ids = np.concatenate([np.minimum(2.0 ** r.uniform(0, 17, 9000), 131_071).astype(np.int64) - 1, np.full(5000, 131_070), np.zeros(5000, np.int64)])
    assert decode_blocks(encode_blocks(ids, len(ids)), [len(ids)]).tolist() == ids.tolist()
    bad = decode_blocks([r.bytes(40), r.bytes(8)], [500, 500])  # gives other ids, which the checksum shows
    assert len(bad) == 1000 and 0 <= bad.min() and bad.max() <= 131_070


def test_a_cache_that_starts_anew_changes_nothing(monkeypatch):
    w, t = K.Words(PATH), tokenizer()
    monkeypatch.setattr(K, "CACHE_WORDS", 5)
    for text in ("one two, three four five six", "two seven. eight", "one two,"):
        ids, count = w.encode_all(pa.array([text, ""]))
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids and count.tolist() == [len(ids), 0]
    assert len(w.words.names) <= 8
