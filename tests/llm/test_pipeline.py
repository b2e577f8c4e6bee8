from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline as P
from geomart.llm import bpe, compression, decontaminate, neardup

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    labels, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, stage in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        if name == "quality":
            want = {r.doc_id for r in compression.predict(docs, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            want = {r.doc_id for r in neardup.cluster(docs).where("kept").collect()}
        elif name == "decontamination":
            want = {r.doc_id for r in decontaminate.flag(docs, items).where("NOT contaminated").collect()}
        else:
            want = set(before)
        assert set(ids) == want
        if name == "tokenization":
            lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
            for r in out.collect():
                assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode_ordinary(before[r.doc_id])
        else:
            assert out.columns == columns
        if name not in ("secret_scan", "tokenization"):
            assert all(before[r.doc_id] == r.text for r in out.collect())
        docs = out


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


@pytest.mark.parametrize("name", ["op3_warc", "op8_decontamination"])
def test_queries_run(spark, name):
    assert E.queries()[name](spark, SMALL).count() > 0
