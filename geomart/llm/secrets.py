"""Secret scan: fixed rules, and a linear-chain conditional random field around them.

The rules' hits in a bounded sample of documents teach the field, which tags each token as begin, inside
or outside of a secret from its shape, the words beside it and features of the file. Emission scores are
table look-ups over whole arrays of tokens. A token whose score for "outside" leads by
more than any change of its neighbours could win back is outside in the best path; Viterbi
runs over the stretches between such tokens, which gives the best path of the whole text.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from geomart.llm.common import arrow_schema, released, texts_of

# The rules, and the kinds in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of the class, as long as it goes, of 24 or more
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "crf")

#: Documents, at most, that the field learns from (chosen by hash of the id).
SAMPLE_ROWS = 4000
CONTEXT = 12
REDRAWN = 12  # times that a hit is seen with a value of another kind
SLICE_CHARS = 1_000_000

OUT, BEGIN, IN = 0, 1, 2
NEVER = -1e9
WORDS = 4096  # hashed words of each neighbour
SHAPES = 384 + 128
FILES = 16
TABLES = (SHAPES, WORDS, WORDS, WORDS, FILES)

SPACE, UPPER, LOWER, DIGIT, SIGN, PUNCT = range(6)
CLASS = np.full(128, SPACE, np.uint8)
CLASS[33:127] = PUNCT
CLASS[48:58], CLASS[65:91], CLASS[97:123] = DIGIT, UPPER, LOWER
CLASS[[ord(c) for c in "+/_-"]] = SIGN
POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, start of the secret itself)`` of each hit of the rules, in order."""
    found = []
    small = text.lower()
    if any(k in small for k in KEYWORDS) or not small.isascii():
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass
class Tokens:
    """Tokens of many texts: which text, where in it, and their feature numbers (one row per table)."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray


def tokenize(texts: list[str]) -> Tokens:
    """Runs of letters, digits and ``+/_-`` are tokens, and so is each other sign that isn't a space."""
    joined = "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    size = np.array([len(t) + 1 for t in texts])
    begin = np.cumsum(size) - size
    cls = np.where(cp < 128, CLASS[np.minimum(cp, 127)], LOWER).astype(np.uint8)
    for c in (0x85, 0xA0, 0x3000):
        cls[cp == c] = SPACE
    word = (cls > SPACE) & (cls < PUNCT)
    first = word.copy()
    first[1:] &= ~word[:-1]
    first |= cls == PUNCT
    at = np.flatnonzero(first)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, np.zeros((len(TABLES), 0), np.int64))
    counted = np.add.reduceat((cls != SPACE).astype(np.int64), at)  # spaces follow the token, so this is its length
    packed = np.add.reduceat((np.int64(1) << np.array([0, 0, 16, 32, 48, 0], np.int64))[cls] * word * (cls != UPPER), at)
    upper = np.add.reduceat((cls == UPPER).astype(np.int64), at)
    change = np.zeros(len(cp), np.int64)
    change[1:] = (cls[1:] != cls[:-1]) & word[1:] & word[:-1]
    changes = np.add.reduceat(change, at)
    low, digit, sign = packed >> 16 & 0xFFFF, packed >> 32 & 0xFFFF, packed >> 48 & 0x7FFF
    bucket = np.searchsorted([2, 4, 6, 9, 13, 20, 32], counted, "right")
    kinds = (upper > 0) * 1 + (low > 0) * 2 + (digit > 0) * 4 + (sign > 0) * 8
    shape = (bucket * 16 + kinds) * 3 + np.searchsorted([2, 5], changes, "right")
    punct = cls[at] == PUNCT
    shape = np.where(punct, 384 + np.minimum(cp[at], 127), shape)
    # the word itself: the first 64 characters, capitals as small letters
    inside = np.arange(len(cp)) - np.repeat(at, np.diff(np.append(at, len(cp))))[: len(cp)] if at[0] == 0 else None
    if inside is None:
        owner = np.repeat(at, np.diff(np.append(at, len(cp))))
        inside = np.concatenate((np.full(at[0], 64), np.arange(at[0], len(cp)) - owner))
    small = np.where(cls == UPPER, cp + 32, cp).astype(np.uint64)
    small[(cls == SPACE) | (inside >= 64)] = 0
    code = np.add.reduceat(small * POWERS[np.minimum(inside, 63)], at)
    code = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code >> np.uint64(40)).astype(np.int64) % (WORDS - 1) + 1  # 0 is the border of a text
    doc = np.searchsorted(begin, at, "right") - 1
    same = doc[1:] == doc[:-1]
    before = np.zeros(len(at), np.int64)
    before[1:] = code[:-1] * same
    before2 = np.zeros(len(at), np.int64)
    before2[2:] = code[:-2] * (doc[2:] == doc[:-2])
    after = np.zeros(len(at), np.int64)
    after[:-1] = code[1:] * same
    # the file: its shares of digits and of signs
    digits = np.add.reduceat((cls == DIGIT).astype(np.int64), begin) / size
    signs = np.add.reduceat(((cls == PUNCT) | (cls == SIGN)).astype(np.int64), begin) / size
    file = np.searchsorted([1e-9, 0.01, 0.05], digits, "right") * 4 + np.searchsorted([0.02, 0.05, 0.12], signs, "right")
    features = np.stack([shape, before, before2, after, file[doc]])
    start = at - begin[doc]
    return Tokens(doc, start, start + counted, features)


@dataclass
class Field:
    """Weights: a table of three states for each kind of feature, and of steps between states."""

    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros((n, 3)) for n in TABLES])
    steps: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return sum(t[f] for t, f in zip(self.tables, features))

    def allowed(self) -> np.ndarray:
        steps = self.steps.copy()
        steps[OUT, IN] = NEVER
        return steps


def fit(features: np.ndarray, tags: np.ndarray, real: np.ndarray, rounds: int = 80, ridge: float = 0.02) -> Field:
    """Maximum conditional likelihood by full-batch AdaGrad; gradients by forward-backward.

    ``features`` is (tables, windows, tokens), ``tags`` and ``real`` (not padding) are (windows, tokens).
    A window stands between two tokens outside.
    """
    model = Field()
    n, length = tags.shape
    params = [*model.tables, model.steps]
    past = [np.full(p.shape, 1e-2) for p in params]
    hot = np.eye(3)[tags] * real[..., None]
    ends = real.sum(1) - 1
    gold = np.zeros((3, 3))
    padded = np.concatenate((np.zeros((n, 1), int), np.where(real, tags, OUT), np.zeros((n, 1), int)), axis=1)
    inside = np.arange(length + 1)[None, :] <= ends[:, None] + 1
    np.add.at(gold, (padded[:, :-1][inside], padded[:, 1:][inside]), 1)
    for _ in range(rounds):
        e = model.emissions(features)
        steps = model.allowed()
        alpha, beta = np.zeros((length, n, 3)), np.zeros((length, n, 3))
        alpha[0] = e[:, 0] + steps[OUT]
        for t in range(1, length):
            a = np.logaddexp.reduce(alpha[t - 1][:, :, None] + steps[None], axis=1) + e[:, t]
            alpha[t] = np.where(real[:, t, None], a, alpha[t - 1])
        z = np.logaddexp.reduce(alpha[-1] + steps[:, OUT][None], axis=1)
        beta[-1] = steps[:, OUT][None]
        for t in range(length - 2, -1, -1):
            b = np.logaddexp.reduce(steps[None] + (e[:, t + 1] + beta[t + 1])[:, None, :], axis=2)
            beta[t] = np.where(real[:, t + 1, None], b, steps[:, OUT][None])
        p = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2) * real[..., None]
        pair = np.zeros((3, 3))
        for t in range(1, length):
            x = alpha[t - 1][:, :, None] + steps[None] + (e[:, t] + beta[t])[:, None, :] - z[:, None, None]
            pair += (np.exp(np.minimum(x, 0)) * real[:, t, None, None]).sum(0)
        pair[OUT] += p[:, 0].sum(0)
        pair[:, OUT] += p[np.arange(n), ends].sum(0)
        diff = (hot - p).reshape(-1, 3)
        grads = []
        for table, f in zip(model.tables, features):
            g = np.stack([np.bincount(f.reshape(-1), diff[:, s], len(table)) for s in range(3)], axis=1)
            grads.append(g - ridge * table)
        grads.append(gold - pair - ridge * model.steps)
        for q, g, h in zip(params, grads, past):
            h += g * g
            q += 0.5 * g / np.sqrt(h)
    return model


def viterbi(e: np.ndarray, steps: np.ndarray) -> list[int]:
    """The best tags of a stretch that stands between two tokens outside."""
    best = [(e[0][s] + steps[OUT][s]) for s in range(3)]
    back = []
    for row in e[1:]:
        came = [max(range(3), key=lambda a: best[a] + steps[a][s]) for s in range(3)]
        best = [best[a] + steps[a][s] + row[s] for s, a in enumerate(came)]
        back.append(came)
    tag = max(range(3), key=lambda s: best[s] + steps[s][OUT])
    tags = [tag]
    for came in reversed(back):
        tag = came[tag]
        tags.append(tag)
    return tags[::-1]


def worth(steps: np.ndarray) -> float:
    """The most that steps can lose if one token is set outside (and a next inside to begin)."""
    most = 0.0
    for a in range(3):
        for x in (BEGIN, IN):
            if steps[a, x] <= NEVER / 2:
                continue
            for b in range(3):
                if b != IN:
                    most = max(most, steps[a, x] + steps[x, b] - steps[a, OUT] - steps[OUT, b])
                    continue
                for c in range(3):
                    gain = steps[a, x] + steps[x, IN] + steps[IN, c] - steps[a, OUT] - steps[OUT, BEGIN] - steps[BEGIN, c]
                    most = max(most, gain)
    return most


def tagged(texts: list[str], model: Field) -> list[list[tuple[int, int]]]:
    """Spans of each text that the field tags as secret."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    tok = tokenize(texts)
    if not len(tok.doc):
        return out
    e = model.emissions(tok.features)
    steps = model.allowed()
    lead = e[:, OUT] - np.maximum(e[:, BEGIN], e[:, IN])
    restart = np.append(np.maximum(0, e[1:, IN] - e[1:, BEGIN]), 0)
    open_ = np.flatnonzero(lead <= worth(steps) + restart + 1e-9)
    if not len(open_):
        return out
    cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(tok.doc[open_]) > 0)) + 1
    table = steps.tolist()
    for run in np.split(open_, cut):
        if len(run) == 1 and lead[run[0]] > 0 and lead[run[0]] + 2 * steps[OUT, OUT] > steps[OUT, BEGIN] + steps[BEGIN, OUT]:
            continue  # alone, and better outside
        tags = viterbi(e[run].tolist(), table)
        spans = out[tok.doc[run[0]]]
        for i, tag in zip(run.tolist(), tags):
            if tag == BEGIN:
                spans.append((int(tok.start[i]), int(tok.end[i])))
            elif tag == IN:
                spans[-1] = (spans[-1][0], int(tok.end[i]))
    return out


def in_slices(texts: list[str], limit: int) -> Iterator[list[str]]:
    """Consecutive texts of at most ``limit`` characters together (one text at least)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > limit:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield texts[begin:]


def windows(texts: list[str], other_each: int = 400) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training windows of one slice: around each token that the rules hit, and others spread evenly."""
    tok = tokenize(texts)
    tags = np.zeros(len(tok.doc), int)
    bounds = np.searchsorted(tok.doc, np.arange(len(texts) + 1))
    for d, text in enumerate(texts):
        a, b = bounds[d], bounds[d + 1]
        for _, _, end, begin in base_spans(text):
            i = a + np.searchsorted(tok.end[a:b], begin, "right")
            j = a + np.searchsorted(tok.start[a:b], end, "left")
            if i < j:
                tags[i] = BEGIN
                tags[i + 1 : j] = IN
    hit = np.flatnonzero(tags == BEGIN)
    n_other = min(len(tags), max(other_each, 3 * len(hit)))
    other = np.unique(np.linspace(0, len(tags) - 1, n_other).astype(int)) if len(tags) else np.zeros(0, int)
    # what looks most like a secret and isn't one: long tokens that mix letters and digits
    shape = tok.features[0]
    kinds = shape // 3 % 16
    hard = np.flatnonzero((tags == OUT) & (shape < 384) & (shape // 48 >= 3) & (kinds & 4 > 0) & (kinds & 3 > 0))
    hard = hard[np.unique(np.linspace(0, len(hard) - 1, other_each).astype(int))] if len(hard) else hard
    middle = np.concatenate((hit, hit, np.tile(hit, REDRAWN), other, hard))
    at = middle[:, None] + np.arange(-CONTEXT, CONTEXT + 1)
    inside = (at >= 0) & (at < len(tags))
    at = np.clip(at, 0, max(0, len(tags) - 1))
    inside &= tok.doc[at] == tok.doc[middle][:, None] if len(tags) else False
    # real tokens to the front, so that a window is a sequence and then padding
    order = np.argsort(~inside, axis=1, kind="stable")
    at, inside = np.take_along_axis(at, order, 1), np.take_along_axis(inside, order, 1)
    wanted = tags[at]
    wanted[:, 0] = np.where(wanted[:, 0] == IN, BEGIN, wanted[:, 0])  # a window may begin within a secret
    features = tok.features[:, at]
    # Each hit is seen once with its neighbouring words hidden, so that its shape has to tell, and some times among words from
    # elsewhere and with another value in its place, so that the field learns values that the rules have no pattern for.
    features[1:4, len(hit) : 2 * len(hit)] = 0
    drawn = drawn_shapes()
    again = slice(2 * len(hit), (2 + REDRAWN) * len(hit))
    features[1:4, again] = tok.features[1:4, (at[again] * 7919 + 101) % max(1, len(tags))]
    value = (wanted[again] != OUT) & (features[0, again] < 384)
    pick = (len(tags) + np.arange(REDRAWN * len(hit))[:, None] * 37 + np.arange(2 * CONTEXT + 1) * 101) % len(drawn)
    features[0, again] = np.where(value, drawn[pick], features[0, again])
    return features, wanted, inside


@lru_cache(maxsize=1)
def drawn_shapes(each: int = 40, seed: int = 1) -> np.ndarray:
    """Shapes of random values over the alphabets that keys are made of, 16 to 64 characters long."""
    r = random.Random(seed)
    upper, lower, digits = string.ascii_uppercase, string.ascii_lowercase, string.digits
    alphabets = (upper + lower + digits, lower + digits, upper + digits, upper + lower + digits + "_-", upper + lower + digits + "+/")
    values = ["".join(r.choice(a) for _ in range(r.randint(16, 64))) for a in alphabets for _ in range(each)]
    return tokenize(values).features[0]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field taught by what the rules find in at most ``sample_rows`` documents, chosen by hash of the id.

    Of several texts under one id the smallest counts, so the model doesn't follow the order of the rows.
    """
    ids = docs.select(docs["doc_id"].alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = texts_of(docs).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = rows.collect()  # sample_rows at most
    texts = [r.text for r in sorted(rows, key=lambda r: r.doc_id)]
    if not any(texts):
        return Field()
    parts = [windows(part) for part in in_slices(texts, SLICE_CHARS)]
    features = np.concatenate([f for f, _, _ in parts], axis=1)
    tags, real = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    return fit(features, tags, real) if len(tags) else Field()


def outside(start: int, end: int, base: list[tuple[int, int, int]], text: str) -> Iterator[tuple[int, int]]:
    """The parts of a span that no rule's hit covers, without white space at their ends."""
    for a, _, b in [*base, (end, 0, end)]:
        if a > start:
            part = text[start : min(a, end)]
            if part.strip():
                yield start + len(part) - len(part.lstrip()), start + len(part.rstrip())
        start = max(start, b)
        if start >= end:
            return


def find_spans(texts: list[str], model: Field) -> Iterator[list[tuple[int, int, int]]]:
    """``(start, kind, end)`` of each text: hits of the rules, and what the field's spans hold beside them."""
    for part in in_slices(texts, SLICE_CHARS):
        for text, more in zip(part, tagged(part, model)):
            base = [(s, k, e) for s, k, e, _ in base_spans(text)]
            added = [(a, 3, b) for s, e in more for a, b in outside(s, e, base, text)]
            yield sorted(base + added)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans`` of every document.

    A null text is empty and has no spans; null ids and repeated rows pass through; an empty
    table gives no rows; further columns are not read; texts of any length are tagged whole.
    Spans of the same start are in the order of the kinds.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string"
    target = arrow_schema(docs, schema)
    model = train(docs, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(find_spans(b.column("text").to_pylist(), model))
            out = {
                f"n_{kind}": [sum(k == i for _, k, _ in r) for r in rows] for i, kind in enumerate(KINDS)
            }
            base = [listed([x for x in r if x[1] < 3]) for r in rows]
            out |= {
                "doc_id": b.column("doc_id"),
                "base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in base],
                "spans": [listed(r) for r in rows],
            }
            yield pa.RecordBatch.from_pydict({c: out[c] for c in target.names}, schema=target)

    return texts_of(docs).mapInArrow(released(run), schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with each secret span (joined where they overlap or touch) replaced by ``mark``.

    Keeps all rows and columns; an integer ``n_chars`` is the length of the new text, one of another type stays as
    it is. A null text stays null, an empty one empty; null ids and repeated rows pass through; an empty table gives
    no rows; texts of any length are searched whole.
    """
    target = to_arrow_schema(docs.schema)
    model = train(docs, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            new = []
            for text, spans in zip(texts, find_spans([t or "" for t in texts], model)):
                parts, done = [], -1
                for s, _, e in spans:
                    if e <= done:
                        continue
                    if s > done:
                        parts += [text[max(done, 0) : s], mark]
                    done = e
                new.append(text if not spans else "".join(parts) + text[done:])
            columns = dict(zip(b.schema.names, b.columns)) | {"text": pa.array(new, pa.string())}
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                own = columns["n_chars"].to_pylist()
                columns["n_chars"] = [len(t) if t is not None and t != old else n for t, old, n in zip(new, texts, own)]
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in target.names}, schema=target)

    return docs.mapInArrow(released(run), docs.schema)
