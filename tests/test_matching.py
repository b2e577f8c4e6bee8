from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from geomart.functions import fuzzy
from geomart.operators import matching as M


def texts(n, seed, letters="abcdefgh", longest=12):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(0, longest))) for _ in range(n)})


def misspelled(words, seed):
    r = random.Random(seed)
    out = []
    for w in words:
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w = r.choice([w[:at] + r.choice("abcü") + w[at:], w[:at] + w[at + 1 :], w[:at] + "x" + w[at + 1 :]])
        out.append(w)
    return out


def one(spark, items, name):
    return spark.createDataFrame([(x,) for x in items], f"{name} string")


@pytest.mark.parametrize(("scorer", "cutoff"), [("levenshtein", 85), ("levenshtein", 60), ("levenshtein", 34), ("levenshtein", 100), ("indel", 85), ("indel", 50)])
def test_candidates_hold_every_pair_at_the_cutoff(spark, scorer, cutoff):
    choices = texts(150, 1) + texts(40, 2, "ab", 5) + ["ü" * 4, "aaaaaaaa", "abababab"]
    values = misspelled(choices, 3) + texts(60, 4) + ["", "a", "aaaaaaa"]
    left, right = one(spark, [*values, None], "v"), one(spark, [*choices, None], "c")
    every = one(spark, sorted(set(values)), "value").join(one(spark, sorted(set(choices)), "choice"), F.lit(True))
    score = fuzzy.SCORERS[scorer](F.col("value"), F.col("choice"))
    want = every.where(score >= cutoff)
    got = M.candidates(left, right, cutoff, scorer)
    assert got.count() == got.distinct().count()
    assert rows(got.where(score >= cutoff)) == rows(want)


def test_long_list_scores_few_pairs_and_equals_all_pairs(spark):
    r = random.Random(5)
    choices = sorted({"".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(5, 14))) for _ in range(10_000)})
    values = misspelled(r.sample(choices, 300), 6) + [None]
    df = one(spark, values, "v")
    table = spark.createDataFrame([(c, -i) for i, c in enumerate(choices)], "c string, at int")
    pairs = M.candidates(df, table.select("c"), 80).count()
    assert pairs < 0.01 * 300 * len(choices)
    got = {row.v: row.m for row in M.match_by_table(df, "v", table, "c", "at", 80, out="m").collect()}
    every = df.where("v IS NOT NULL").distinct().join(F.broadcast(table), F.abs(F.length("v") - F.length("c")) < 5)
    every = every.withColumn("score", fuzzy.levenshtein_ratio(F.col("v"), F.col("c"))).where("score >= 80")
    best = every.groupBy("v").agg(F.max_by("c", F.struct("score", (-F.col("at")).alias("first"))).alias("m"))
    want = {row.v: row.m for row in best.collect()}
    assert got == {v: want.get(v, v) for v in values}


def test_ties_nulls_and_refusals(spark):
    df = spark.createDataFrame([(1, "abcdefgx"), (2, None), (3, "zzzz"), (4, "")], "id int, v string")
    table = spark.createDataFrame([("abcdefgh", 2), ("abcdefgi", 1), ("abcdefgi", 5), (None, 0)], "c string, at int")
    got = M.match_by_table(df, "v", table, "c", "at", 80)
    assert rows(got) == [(1, "abcdefgi"), (2, None), (3, "zzzz"), (4, "")] and got.columns == ["id", "v"]
    assert rows(M.match_by_table(df, "v", table.limit(0), "c", "at", 80)) == rows(df)
    with pytest.raises(ValueError, match="weighted"):
        M.candidates(df.select("v"), table.select("c"), 80, "weighted")


def test_indel_edits_apart_from_each_other(spark):
    """A letter taken out and one put in elsewhere are two edits of the indel score."""
    got = M.candidates(one(spark, ["axbcdfgh"], "v"), one(spark, ["abcdefgh"], "c"), 87.5, "indel")
    assert rows(got) == [("axbcdfgh", "abcdefgh")]


def test_words_meet_by_few_pieces(spark):
    r = random.Random(7)
    words = sorted({"".join(r.choice("aeioulmnrst") for _ in range(r.randint(5, 12))) for _ in range(3000)})
    df = one(spark, words, "w")
    edits = lambda a, b: F.floor(F.greatest(a, b) * 0.2 + M.TINY).cast("int")
    left = M.pieces(df.withColumnRenamed("w", "value"), "value", 0.8, edits, False)
    right = M.pieces(df.withColumnRenamed("w", "choice"), "choice", 0.8, edits, True)
    assert left.count() < 25 * len(words)
    assert left.join(right, ["m", "most", "i", "piece"]).count() < 0.02 * len(words) ** 2
