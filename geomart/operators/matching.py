"""Fuzzy matching against long lists of choices: only pairs that share a piece or enough q-grams are scored.

Exact at the cutoff. If two texts score at least the cutoff, the edits between them are few, by their lengths. Where that is
at most ``FEW``, the choice is cut into one piece more than there may be edits: one piece is then whole in the value, at a place that differs by
no more than the edits before and behind it, and texts are joined by that piece. Elsewhere each edit
destroys at most ``q`` of the q-grams of the longer text; so they share at least a known number of q-grams
(count filter), and the rarest few q-grams of each must have one in common (prefix filter), by which
they are joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomart.functions.fuzzy import SCORERS

Q = 2
FEW = 3  # pieces are long and few up to so many edits
#: The share of the longer text's length that the shorter one has at least, for a score of c (0 to 1).
LEAST_SHARE = {"levenshtein": lambda c: c, "indel": lambda c: c / (2 - c)}
#: The length of which 1 - c is the most edits: the longer text's, or both together where a change is two edits.
EDITED = {"levenshtein": lambda a, b: F.greatest(a, b), "indel": lambda a, b: a + b}
TINY = 1e-9


def grams(text: Column, q: int = Q) -> Column:
    """The q-grams of a text as an array; equal ones are told apart by their number, as ``gram`` and ``n``."""
    n = F.length(text)
    plain = F.when(n >= q, F.transform(F.sequence(F.lit(1), n - (q - 1)), lambda i: F.substring(text, i, F.lit(q))))
    plain = F.coalesce(plain, F.array().cast("array<string>"))
    once = F.transform(plain, lambda g: F.struct(g.alias("gram"), F.lit(1).alias("n")))
    numbered = F.transform(
        plain,
        lambda g, i: F.struct(
            g.alias("gram"), F.size(F.filter(F.slice(plain, F.lit(1), i + 1), lambda x: x == g)).alias("n")
        ),
    )
    return F.when(F.size(F.array_distinct(plain)) == F.size(plain), once).otherwise(numbered)


def lengths(length: Column, share: float) -> Column:
    """All lengths of a text that may match one of ``length`` characters, as an array."""
    return F.sequence(F.ceil(length * share - TINY).cast("int"), F.floor(length / share + TINY).cast("int"))


def start(length: Column, most: Column, i: Column) -> Column:
    """Where (from 0) piece ``i`` (from 0) of ``most + 1`` even pieces of a text begins; piece ``most + 1`` begins at the end."""
    return F.floor(length * i / (most + 1)).cast("int")


def pieces(texts: DataFrame, name: str, share: float, edits: Callable[[Column, Column], Column], cut: bool) -> DataFrame:
    """``name, m, most, i, piece``: the pieces that a pair must share, for every length that the other text may have.

    A choice (``cut``) of ``m`` characters is cut into ``most + 1`` pieces; of a value those parts are listed that may be piece ``i`` of a
    choice of ``m`` characters. If ``most`` edits fall on ``most + 1`` pieces, there is a first piece ``i`` up to which no more than ``i`` edits were made; it
    has none, ``i`` lie before it and ``most - i`` at most behind. So it is shifted by no more than either, seen from the left and from the right end.
    """
    n = F.length(name)
    least = F.ceil(n * share - TINY).cast("int")
    own = texts.where(edits(n, least) <= FEW).select(name, n.alias("n"), F.explode(lengths(n, share)).alias("other"))
    own = own.select(name, "n", (F.col("n") if cut else F.col("other")).alias("m"), edits(F.col("n"), F.col("other")).alias("most"))
    own = own.where(F.col("most").between(1, FEW) & (F.col("most") < F.col("m")))
    if cut:
        own = own.distinct()
    own = own.select("*", F.explode(F.sequence(F.lit(0), "most")).alias("i"))
    first, longer = start(F.col("m"), F.col("most"), F.col("i")), F.col("n") - F.col("m")
    size = start(F.col("m"), F.col("most"), F.col("i") + 1) - first
    behind = F.col("most") - F.col("i")
    low = F.greatest(first - F.col("i"), first + longer - behind, F.lit(0))
    high = F.least(first + F.col("i"), first + longer + behind, F.col("n") - size)
    places = F.array(first) if cut else F.when(low <= high, F.sequence(low, high))
    own = own.select(name, "m", "most", "i", size.alias("size"), F.explode(places).alias("at"))
    return own.select(name, "m", "most", "i", F.substring(name, F.col("at") + 1, F.col("size")).alias("piece"))


def candidates(values: DataFrame, choices: DataFrame, cutoff: float, scorer: str = "levenshtein", q: int = Q) -> DataFrame:
    """``value, choice``: all pairs that may score ``cutoff`` or more, from the distinct texts of two one-column tables.

    Four joins, none of them of all pairs: equal texts; texts between which few edits may lie, by a piece that was not edited; texts
    that share one of their rarest q-grams, checked by length and by the number of q-grams in common; and, among texts too
    short for either, those of lengths that fit.
    """
    if scorer not in LEAST_SHARE:
        raise ValueError(f"{scorer}: q-grams in common say nothing about this score")
    c = cutoff / 100
    share = LEAST_SHARE[scorer](c)
    if share <= 0:
        raise ValueError("a cutoff above 0 is needed, otherwise every choice matches")
    left = values.toDF("value").where("value IS NOT NULL").distinct()
    right = choices.toDF("choice").where("choice IS NOT NULL").distinct()
    equal = left.join(right, F.col("value") == F.col("choice"))

    def edits(a: Column, b: Column) -> Column:
        """The most edits between texts of two lengths."""
        return F.floor(EDITED[scorer](a, b) * (1 - c) + TINY).cast("int")

    length_a, length_b = F.length("value"), F.length("choice")
    longest, shortest = F.greatest(length_a, length_b), F.least(length_a, length_b)
    other = F.col("value") != F.col("choice")
    fits = (shortest >= longest * share - TINY) & other

    def few(a: Column, b: Column) -> Column:
        """Whether pairs of these lengths, the choice's second, are found by pieces."""
        return edits(a, b).between(1, FEW) & (edits(a, b) < b)

    keys = ["m", "most", "i", "piece"]
    near = pieces(left, "value", share, edits, False).join(pieces(right, "choice", share, edits, True), keys)
    near = near.where(other).select("value", "choice").distinct()

    # Above this length of the longer text there always is a q-gram in common.
    per = (1 - c) * (2 if scorer == "indel" else 1)
    sure = q / (1 - q * per) if q * per < 1 else float("inf")

    # Rare q-grams first: counted among the choices, where q-grams that no choice has count as rarest.
    def many(texts: DataFrame, name: str) -> DataFrame:
        """The texts that pieces don't settle: with another one of a length that fits, there may be too many edits."""
        n = F.length(name)
        most = F.floor(n / share + TINY).cast("int")
        return texts.where((edits(n, most) > FEW) | (edits(n, most) >= F.ceil(n * share - TINY)))

    known = many(right, "choice").select("choice", F.explode(grams(F.col("choice"), q)).alias("g"))
    often = known.groupBy("g").agg(F.count(F.lit(1)).alias("often"))

    def prefix(texts: DataFrame, name: str) -> DataFrame:
        """The q-grams of which one must be shared: as many as the most edits can destroy, and one more."""
        most = edits(F.length(name), F.floor(F.length(name) / share + TINY)) * q + 1
        own = many(texts, name).where(most > 1).select(name, most.alias("most"), F.explode(grams(F.col(name), q)).alias("g"))
        own = own.join(often, "g", "left").select(name, "most", "g", F.coalesce("often", F.lit(0)).alias("often"))
        ranked = own.groupBy(name, "most").agg(F.array_sort(F.collect_list(F.struct("often", "g"))).alias("gs"))
        return ranked.select(name, F.explode(F.slice("gs", F.lit(1), F.col("most"))["g"]).alias("g"))

    rest = fits & ~few(length_a, length_b)
    met = prefix(left, "value").join(prefix(right, "choice"), "g").where(rest).select("value", "choice").distinct()
    shared = F.size(F.array_intersect(grams(F.col("value"), q), grams(F.col("choice"), q)))
    enough = shared >= longest - (q - 1) - q * edits(length_a, length_b)
    met = met.where(enough)

    # Of short texts the distinct lengths meet first; there are at most ``sure`` of them, or as many as the texts have.
    short_a = left.withColumn("n", length_a).where(F.col("n") <= sure)
    short_b = right.withColumn("m", length_b).where(F.col("m") <= sure)
    n, m = F.col("n"), F.col("m")
    reach = (F.least(n, m) >= F.greatest(n, m) * share - TINY) & (edits(n, m) >= 1) & ~few(n, m)
    reach = short_a.select("n").distinct().join(short_b.select("m").distinct(), reach)
    short = short_a.join(reach, "n").join(short_b, "m").where(other).select("value", "choice")
    return equal.unionByName(near).unionByName(met).unionByName(short).distinct()


def match_by_table(
    df: DataFrame,
    column: str,
    choices: DataFrame,
    choice: str,
    order: str,
    cutoff: float,
    scorer: str = "levenshtein",
    out: str | None = None,
) -> DataFrame:
    """Replace each value by the best choice that scores ``cutoff`` or more, else keep it; NULL stays NULL.

    ``choices`` may be long; of choices with the best score the least ``order`` wins, as in a list in that order. Distinct
    values are matched once and joined back.
    """
    out = out or column
    first = choices.where(F.col(choice).isNotNull()).groupBy(F.col(choice).alias("choice")).agg(F.min(order).alias("place"))
    pairs = candidates(df.select(column), choices.select(choice), cutoff, scorer)
    scored = pairs.withColumn("score", SCORERS[scorer](F.col("value"), F.col("choice"))).where(F.col("score") >= cutoff)
    best = F.max_by("choice", F.struct("score", (-F.col("place")).alias("first")))
    best = scored.join(first, "choice").groupBy(F.col("value").alias(column)).agg(best.alias("__match"))
    columns = df.columns if out in df.columns else [*df.columns, out]
    return df.join(best, column, "left").withColumn(out, F.coalesce("__match", column)).select(*columns)
