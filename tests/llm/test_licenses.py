from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geomart.llm import licenses as L
from tests.llm.conftest import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

ODD = [
    "CC BY cc-by CC\x00BY ccby cc by",
    "general public license" * 3,
    " GENERAL  PUBLIC\nLicense all rights reserved all rights reserved",
    "all all rights reserved rights reserved cc cc by by",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nx",
    "İcc by ſ all rights reserved. ẞ general public licenſe",
    "中文 cc by 中文cc by",
]


def expected(text: str):
    words = WORD.findall(lower(text))
    found = []
    for phrase, label in BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_equals_brute_force(spark, docs, texts):
    r = random.Random(7)
    parts = [*" ".join(L.NOTICES).split(), "rights", "reserved", "all", "-", "\n", "İ", "x.", "cc by"]
    more = ODD + ["".join(r.choice(parts) + r.choice([" ", " ", "-", "", "\x00"]) for _ in range(80)) for _ in range(300)]
    extra = spark.createDataFrame(list(enumerate(more, 50_000)), "doc_id long, text string")
    got = L.summary(docs.select("doc_id", "text").unionAll(extra)).collect()
    want = [(i, *expected(t)) for i, t in [*texts, *enumerate(more, 50_000)]]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels) and 0 <= r.score <= 1
    assert L.summary(docs).count() == docs.count() and L.scan(docs.where("false")).count() == 0


def test_notices_equal_brute_force():
    r = random.Random(8)
    phrases = {**L.NOTICES, **L.BASE}
    vocabulary = sorted({w for p in phrases for w in p.split()}) + ["x"]
    for _ in range(300):
        words = [r.choice(vocabulary) for _ in range(5)] + r.choice(list(phrases)).split() + ["x"] * r.randint(0, 2) + r.choice(list(phrases)).split()
        want = sorted((i, label, p in L.BASE) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert L.places(" " + " ".join(words) + " ") == want
    assert L.places(" ") == []


@pytest.mark.parametrize(
    ("line", "value", "named", "expression"),
    [
        ("spdx-license-identifier: mit", 0.1, ["mit"], "mit"),
        ("spdx-license-identifier: mit or gpl-3.0-only */", 0.1, ["gpl-3.0-only", "mit"], "mit or gpl-3.0-only"),
        ("spdx-license-identifier: mit and gpl-3.0-only or 0bsd", 0.0, ["0bsd", "gpl-3.0-only", "mit"], "mit and gpl-3.0-only or 0bsd"),
        ("spdx-license-identifier: mit and (gpl-3.0+ or lgpl-2.1)", 0.5, ["gpl-3.0+", "lgpl-2.1", "mit"], "mit and (gpl-3.0+ or lgpl-2.1)"),
        ("spdx-license-identifier: gpl-2.0 with classpath-exception-2.0", 0.7 * 0.7, ["gpl-2.0"], "gpl-2.0 with classpath-exception-2.0"),
        ("spdx-license-identifier: mit or gpl-2.0 with x-exception and agpl-3.0", 0.1, ["agpl-3.0", "gpl-2.0", "mit"], "mit or gpl-2.0 with x-exception and agpl-3.0"),
        ("spdx-license-identifier: ((mit", 0.1, ["mit"], "((mit"),
        ("spdx-license-identifier: mit) and agpl-3.0", 0.1, ["mit"], "mit"),
        ("spdx-license-identifier: mit and", 0.1, ["mit"], "mit"),
        ("spdx-license-identifier: mit or (", 0.1, ["mit"], "mit"),
        ("spdx-license-identifier: licenseref-own", 0.5, ["licenseref-own"], "licenseref-own"),
        ("license: apache-2.0. and mit", 0.15, ["apache-2.0"], "apache-2.0"),
        ("license: see below", None, None, None),
        ("license: or mit", None, None, None),
        ("license:", None, None, None),
        ("license: ()", None, None, None),
    ],
)
def test_expressions(line, value, named, expression):
    got = L.expressions("x\n" + line + "\nmit")
    if value is None:
        assert got == []
    else:
        ((start, text, found, names),) = got
        assert (start, text, names) == (2 + line.index(":") + 1, expression, named) and found == pytest.approx(value)


def test_deep_expression():
    text = "license: " + "(" * 50_000 + "mit" + ")" * 50_000 + " and gpl-2.0" * 50_000
    assert L.expressions(text)[0][2] == 0.7


NAMES = ["mit", "gpl-2.0", "lgpl-2.1", "agpl-3.0", "0bsd", "own"]
TREE = st.recursive(
    st.sampled_from(NAMES) | st.sampled_from(NAMES).map(lambda n: (n, "with")),
    lambda x: st.tuples(st.sampled_from(["and", "or"]), x, x),
    max_leaves=12,
)


def shown(t) -> str:
    if isinstance(t, str):
        return t
    if len(t) == 2:
        return f"{t[0]} with some-exception"
    return f"({shown(t[1])}) {t[0]} ({shown(t[2])})"


def value(t) -> float:
    if isinstance(t, str):
        return L.restriction(t)
    if len(t) == 2:
        return L.restriction(t[0]) * L.LOOSENED
    return (max if t[0] == "and" else min)(value(t[1]), value(t[2]))


@settings(max_examples=200, deadline=None)
@given(TREE)
def test_evaluation_equals_the_tree(tree):
    assert L.expressions(f"spdx-license-identifier: {shown(tree)}")[0][2] == pytest.approx(value(tree))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["and", "or"]), st.sampled_from(NAMES)), min_size=1, max_size=9))
def test_precedence(items):
    """Without brackets: the freest of the groups that ``or`` parts, each as strict as its strictest member."""
    text = "mit" + "".join(f" {op} {name}" for op, name in items)
    want = min(max(L.restriction(n) for n in part.split(" and ")) for part in text.split(" or "))
    assert L.expressions(f"spdx-license-identifier: {text}")[0][2] == pytest.approx(want)
