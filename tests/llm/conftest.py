from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def near_copies(n: int, words: int, changes: int, seed: int) -> list[str]:
    r = random.Random(seed)
    base = [f"w{r.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(1, changes)):
            w[r.randrange(words)] = f"x{r.randint(0, 9)}"
        out.append(" ".join(w))
    return out


EDGES = [
    (20000, ""),
    (20001, None),
    (20002, "a b"),
    (20003, "A  b\n"),
    (20004, "a b c d e"),
    (20005, " \t"),
    (20006, "a b c d e"),
    (20007, "x" * 60_000),
    (20008, "ab " * 20_000),
    (20009, "\x00" * 120),
    (20010, "b\x00" * 60),
    (20011, "ü€😀" * 60),
    (20012, "password=abcdefg AKIA" + "A" * 16 + " token:\"x\" API_KEY = abcdef1 " + "0f" * 12 + " paſſword=1234567"),
    (20013, "it's. \"x\". a.b,c .,. 12.,. <|endoftext|> café. É̱ H̱. İ x\x1cy\x85z 中文. K"),
    (None, "a b"),
    (None, None),
]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """Whole documents of the smallest table, near copies, and odd rows; twice the row 20006."""
    rows = EDGES + [(30000 + i, t) for i, t in enumerate(near_copies(60, 120, 7, 3))] + [EDGES[6]]
    own = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    df = own.unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    # columns that the operators also use inside
    extra = df.select("doc_id", "text", F.lit(1).alias("score"), F.lit(2).alias("bucket"), F.lit("z").alias("digest"), F.lit("y").alias("label"))
    path = str(tmp_path_factory.mktemp("docs") / "d")
    extra.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
