"""Text similarity in 0..100.

``levenshtein_ratio`` stays in the JVM. ``indel_ratio`` and ``weighted_ratio`` need the
longest common subsequence, which no built-in gives; they are Arrow-batched helpers that
the standardiser calls on distinct values only.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Send the scorers themselves to the workers, which then need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The weights of the token, partial and long-partial scores, and the length
# ratios at which the partial scores come in and are weakened.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6
PARTIAL_FROM = 1.5
LONG_FROM = 8.0


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one row of bits per character."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & where.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def _ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * _common(a, b) / total if total else 100.0


def _partial(a: str, b: str) -> float:
    """Best ratio of the shorter text against a window of the longer one."""
    short, long_ = sorted((a, b), key=len)
    if not short:
        return 0.0 if long_ else 100.0
    n = len(short)
    return max(_ratio(short, long_[max(0, end - n) : end]) for end in range(1, len(long_) + n))


def _weighted(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    whole = _ratio(a, b)
    words_a, words_b = a.split(), b.split()
    sorted_a, sorted_b = " ".join(sorted(words_a)), " ".join(sorted(words_b))
    both = sorted(set(words_a) & set(words_b))
    only_a = " ".join(sorted(set(words_a) - set(words_b)))
    only_b = " ".join(sorted(set(words_b) - set(words_a)))
    if longer / shorter < PARTIAL_FROM:
        return max(whole, TOKEN_WEIGHT * max(_ratio(sorted_a, sorted_b), _word_sets(both, only_a, only_b)))
    weight = PARTIAL_WEIGHT if longer / shorter <= LONG_FROM else LONG_PARTIAL_WEIGHT
    words = 100.0 if both else max(_partial(sorted_a, sorted_b), _partial(only_a, only_b))
    return max(whole, weight * _partial(a, b), TOKEN_WEIGHT * weight * words)


def _word_sets(both: list[str], only_a: str, only_b: str) -> float:
    """Shared words against shared words plus the rest of either side."""
    if both and not (only_a and only_b):
        return 100.0
    shared = " ".join(both)
    full_a, full_b = (f"{shared} {rest}".strip() for rest in (only_a, only_b))
    distance = len(only_a) + len(only_b) - 2 * _common(only_a, only_b)
    total = len(full_a) + len(full_b)
    rest_score = 100.0 - 100.0 * distance / total if total else 100.0
    if not both:
        return rest_score
    return max(rest_score, _ratio(shared, full_a), _ratio(shared, full_b))


def _vector(score):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


def indel_ratio(a: Column, b: Column) -> Column:
    return _vector(_ratio)(a, b)


def weighted_ratio(a: Column, b: Column) -> Column:
    return _vector(_weighted)(a, b)


SCORERS = {"levenshtein": levenshtein_ratio, "indel": indel_ratio, "weighted": weighted_ratio}
