"""Licence statements in texts: notice phrases, identifier tags and the expressions behind them.

One Aho-Corasick automaton finds all notice phrases in the words of a text, a second one the identifier
tags in the text itself. The expression after a tag goes through a shunting-yard parser, which evaluates
it while reading: of licences joined by ``or`` the freest may be chosen, of those joined by ``and`` all
hold, and an exception named by ``with`` loosens its licence. Every task does this for the rows it
reads; there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.llm.common import LOWER, arrow_schema, released, texts_of

#: Phrases of the contract and their labels. Fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further notice phrases, as words of small letters and digits, and what they state.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "general public license version 2 or later": "gpl-2.0-or-later",
    "general public license version 3 or later": "gpl-3.0-or-later",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain dedication": "public-domain",
    "dedicated to the public domain": "public-domain",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
}

#: Tags before an expression. After the first any identifier counts, after the others known ones only.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")

#: How far a licence restricts use, by family: 0 not at all, 1 nothing is allowed.
RESTRICTION = {
    "0bsd": 0.0,
    "agpl": 0.8,
    "apache": 0.15,
    "bsd": 0.1,
    "bsl": 0.1,
    "cc-by": 0.2,
    "cc-by-nc": 0.7,
    "cc-by-nd": 0.6,
    "cc-by-sa": 0.4,
    "cc0": 0.0,
    "epl": 0.45,
    "gpl": 0.7,
    "isc": 0.1,
    "lgpl": 0.5,
    "mit": 0.1,
    "mpl": 0.4,
    "public-domain": 0.0,
    "reserved": 1.0,
    "unlicense": 0.0,
    "zlib": 0.1,
}
UNKNOWN = 0.5
LOOSENED = 0.7  # of a licence's restriction stays under an exception

#: Small letters, digits and all bytes beyond ASCII stay, the rest parts words.
TO_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in LOWER)
SPACES = re.compile(b" {2,}")
SIGN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")

PLACES = "array<struct<word: long, label: string, base: boolean>>"
EXPRESSIONS = "array<struct<start: long, expression: string, restriction: double, labels: array<string>>>"
SCHEMA = f"doc_id long, n_words long, places {PLACES}, expressions {EXPRESSIONS}, score double"


def family(name: str) -> str | None:
    """The longest known family that an identifier begins with, whole parts only; None if there is none."""
    name = name.rstrip("+")
    while name not in RESTRICTION:
        name, dash, _ = name.rpartition("-")
        if not dash:
            return None
    return name


def restriction(name: str) -> float:
    return RESTRICTION.get(family(name), UNKNOWN)


RANK = {"or": 1, "and": 2, "with": 3}


def evaluate(signs: Iterator[tuple[str, int]]) -> tuple[int, float, list[str]] | None:
    """Shunting-yard over ``(sign, its end)``: end of the expression, its restriction, the licences it names.

    Reading stops before the first sign that can't go on, so that prose may follow; brackets still
    open are closed then. None if no licence is there. Operands and operators lie on two stacks, so depth and length are
    not limited by the interpreter, and nothing is multiplied out.
    """
    values: list[float] = []
    waiting: list[str] = []
    named: list[str] = []
    done = 0  # where the last whole operand ended
    operand_next = True

    def apply() -> None:
        op, right = waiting.pop(), values.pop()
        if op == "or":
            values[-1] = min(values[-1], right)
        elif op == "and":
            values[-1] = max(values[-1], right)
        else:
            values[-1] *= LOOSENED  # the right one names the exception

    for sign, end in signs:
        if operand_next:
            if sign == "(" and (not waiting or waiting[-1] != "with"):
                waiting.append(sign)
                continue
            if sign in RANK or sign in "()":
                break
            if waiting and waiting[-1] == "with":
                values.append(0.0)
            else:
                named.append(sign.rstrip(".:"))
                values.append(restriction(named[-1]))
            operand_next, done = False, end - (len(sign) - len(sign.rstrip(".:")))
            if done != end:  # a full stop ends the statement
                break
        elif sign == ")":
            while waiting and waiting[-1] != "(":
                apply()
            if not waiting:
                break
            waiting.pop()
            done = end
        elif sign in RANK:
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[sign]:
                apply()
            waiting.append(sign)
            operand_next = True
        else:
            break
    if operand_next:  # an operator without its right side, or brackets that hold nothing
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting:
            waiting.pop()
    if not values:
        return None
    while waiting:
        if waiting[-1] == "(":
            waiting.pop()
        else:
            apply()
    return done, values[0], named


@lru_cache(maxsize=1)
def automata():
    """Of the notice phrases, each between single spaces, and of the tags."""
    import ahocorasick

    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        phrases.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in BASE))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def places(spaced: str) -> list[tuple[int, str, bool]]:
    """``(word, label, base)`` of each phrase in words that stand between single spaces, by word and label."""
    found = sorted((end - back, label, base) for end, (back, label, base) in automata()[0].iter(spaced))
    out, word, at = [], 0, 0
    for start, label, base in found:
        word += spaced.count(" ", at, start)  # the blank before a word has the number of that word
        at = start
        out.append((word, label, base))
    return sorted(out)


def expressions(text: str) -> list[tuple[int, str, float, list[str]]]:
    """``(start, expression, restriction, licences)`` of each tag of a text in small letters, in code points.

    Of several tags that end at one place the longest counts.
    """
    tags = {}
    for end, tag in automata()[1].iter(text):
        tags[end + 1] = max(tag, tags.get(end + 1, ""), key=len)
    out = []
    for start, tag in sorted(tags.items()):

        def signs(at: int = start) -> Iterator[tuple[str, int]]:
            while m := SIGN.match(text, at):
                yield m[1], (at := m.end())

        found = evaluate(signs())
        if found and (tag == TAGS[0] or all(family(name) for name in found[2])):
            end, value, named = found
            out.append((start, text[start:end].strip(), value, sorted(set(named))))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, places, expressions, score`` of every document.

    ``places`` are the notice phrases by number of their first word, ``expressions`` what stands after
    identifier tags, with the place in code points. ``score`` is the strictest statement of the text: 0 where
    nothing restricts its use or nothing is stated, 1 where all rights are reserved. A null text is empty and
    has no words; null ids and repeated rows pass through; an empty table gives no rows; further columns are
    not read; texts of any length are read whole.
    """
    target = arrow_schema(docs, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                raw = text.as_py().encode().translate(LOWER)
                spaced = SPACES.sub(b" ", b" " + raw.translate(TO_WORDS) + b" ").decode()
                found, stated = places(spaced), expressions(raw.decode())
                score = max([restriction(x) for _, x, _ in found] + [x for _, _, x, _ in stated], default=0.0)
                rows.append(
                    {
                        "doc_id": doc_id,
                        "n_words": spaced.count(" ") - 1,
                        "places": [dict(zip(("word", "label", "base"), x)) for x in found],
                        "expressions": [dict(zip(("start", "expression", "restriction", "labels"), x)) for x in stated],
                        "score": score,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return texts_of(docs, id_col, text_col).mapInArrow(released(run), SCHEMA)


def summary(docs: DataFrame) -> DataFrame:
    """Number, first and last place of the base phrases, and the labels; rows as those of :func:`scan`."""
    base = F.filter("places", lambda p: p["base"])
    labels = F.concat(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))

    def joined(names):
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["word"])).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(labels).alias("labels"),
        "score",
        F.size("expressions").cast("long").alias("n_expressions"),
    )
