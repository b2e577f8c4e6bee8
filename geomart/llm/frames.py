"""Fill-in-the-middle over texts that are stored as seekable compressed frames.

A text is kept as independent zstandard frames of a fixed number of code points, with running counts of
the code points and of the units (lines) that have ended up to the end of each frame. To find a cut, the
counts name the one frame it lies in and only that frame is decompressed; what is copied or digested
passes frame by frame. The transformed text is itself such a store, and the restorer reads nothing else.

A store is a table with one row per text; Spark deals out the rows, and no shuffle is needed.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from geomart.llm.common import arrow_schema, released, texts_of
from geomart.session import materialize

#: Code points of a frame; all frames but the last of a text are full.
FRAME_CHARS = 1 << 15
LEVEL = 1

#: Marks before prefix, suffix and middle. Fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

STORE = "frames array<binary>, chars array<long>, units array<long>"
KEPT = f"doc_id long, {STORE}"
TURNED = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, {STORE}"


class Codec:
    """The packer and unpacker of a task."""

    def __init__(self):
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.unpack = zstandard.ZstdDecompressor().decompress


@dataclass
class Frames:
    """Frames of one text; ``chars[i]`` and ``units[i]`` count all code points and line ends up to frame i's end."""

    frames: list[bytes] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    units: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, pieces: Iterable[str], codec: Codec, size: int = FRAME_CHARS) -> Frames:
        """Pack a text that comes in pieces; at most one frame and one piece are held unpacked."""
        out, held, n = cls(), [], 0
        for piece in pieces:
            at = 0
            while n + len(piece) - at >= size:
                held.append(piece[at : (at := at + size - n)])
                out.add("".join(held), codec)
                held, n = [], 0
            if at < len(piece):
                held.append(piece[at:])
                n += len(piece) - at
        if n:
            out.add("".join(held), codec)
        return out

    def add(self, part: str, codec: Codec) -> None:
        self.frames.append(codec.pack(part.encode()))
        self.chars.append(self.n_chars + len(part))
        self.units.append((self.units[-1] if self.units else 0) + part.count("\n"))

    @property
    def n_chars(self) -> int:
        return self.chars[-1] if self.chars else 0

    def part(self, i: int, codec: Codec) -> str:
        return codec.unpack(self.frames[i]).decode()

    def n_units(self, codec: Codec) -> int:
        """Lines ``[^\\n]*\\n|[^\\n]+``: an end that isn't a line end makes one more."""
        if not self.frames:
            return 0
        return self.units[-1] + (not self.part(len(self.frames) - 1, codec).endswith("\n"))

    def cut(self, unit: int, codec: Codec) -> int:
        """Code points of the first ``unit`` units; unpacks one frame at most."""
        if unit <= 0:
            return 0
        i = bisect_left(self.units, unit)
        if i == len(self.units):
            return self.n_chars
        left = unit - (self.units[i - 1] if i else 0)
        part, at = self.part(i, codec), -1
        for _ in range(left):
            at = part.index("\n", at + 1)
        return (self.chars[i - 1] if i else 0) + at + 1

    def stream(self, start: int, end: int, codec: Codec) -> Iterator[str]:
        """The code points from ``start`` to ``end``, frame by frame; other frames stay packed."""
        i = bisect_right(self.chars, start)
        while start < end and i < len(self.frames):
            begin = self.chars[i - 1] if i else 0
            yield self.part(i, codec)[start - begin : end - begin]
            start, i = self.chars[i], i + 1

    def whole(self, codec: Codec) -> Iterator[str]:
        return self.stream(0, self.n_chars, codec)

    def find(self, mark: str, start: int, codec: Codec) -> int:
        """Place of the first ``mark`` from ``start`` on, -1 if there is none; a mark may lie across frames."""
        tail, at = "", start
        for piece in self.stream(start, self.n_chars, codec):
            seen = tail + piece
            if (found := seen.find(mark)) >= 0:
                return at - len(tail) + found
            at += len(piece)
            tail = seen[max(0, len(seen) - len(mark) + 1) :]
        return -1


@dataclass(frozen=True)
class Rule:
    """Which texts are turned, and how: percentages of the digest's third and fourth number."""

    seed: int = 7
    turned: int = 100
    spm: int = 50

    def draws(self, doc_id: int | None) -> list[int]:
        """The first four 32-bit numbers of the digest of seed and id (a null id counts as no digits)."""
        h = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def turn(doc_id: int | None, text: Frames, rule: Rule, codec: Codec) -> tuple[int, str, int | None, int | None, Frames]:
    """Units, form, code points of prefix and middle, and the output."""
    n = text.n_units(codec)
    h1, h2, h3, h4 = rule.draws(doc_id)
    if not n or h3 % 100 >= rule.turned or any(text.find(m, 0, codec) >= 0 for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, end = text.cut(first, codec), text.cut(second, codec), text.n_chars
    form = "spm" if h4 % 100 < rule.spm else "psm"
    order = [(PREFIX, 0, a), (SUFFIX, b, end)]
    parts = [*(order if form == "psm" else order[::-1]), (MIDDLE, a, b)]

    def output() -> Iterator[str]:
        for mark, start, stop in parts:
            yield mark
            yield from text.stream(start, stop, codec)

    return n, form, a, b - a, Frames.of(output(), codec)


def restore(form: str, output: Frames, codec: Codec) -> Iterator[str]:
    """The text behind an output, in pieces, from the output and its form alone."""
    if form == "plain":
        yield from output.whole(codec)
        return
    ahead, behind = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    second = output.find(behind, len(ahead), codec)
    third = output.find(MIDDLE, second + len(behind), codec)
    spans = {ahead: (len(ahead), second), behind: (second + len(behind), third), MIDDLE: (third + len(MIDDLE), output.n_chars)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(*spans[mark], codec)


def digest(pieces: Iterable[str]) -> str:
    h = hashlib.sha256()
    for piece in pieces:
        h.update(piece.encode())
    return h.hexdigest()


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, Frames]]:
    """The rows of a store one by one; only one row's frames are Python objects at a time."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i].as_py() for c in names}
        yield row, Frames(row.pop("frames"), row.pop("chars"), row.pop("units"))


def mapped(df: DataFrame, schema: str, work) -> DataFrame:
    """One row from ``work(row, codec)`` per row; a batch is given out when its rows hold 8 MB."""
    target = arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out, size = Codec(), [], 0
        for b in batches:
            rows = rows_of(b) if "frames" in b.schema.names else zip(*(b.column(c) for c in ("doc_id", "text")))
            for row in rows:
                out.append(work(row, codec))
                size += sum(map(len, out[-1].get("frames") or ()))
                if len(out) >= 5000 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=target)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return df.mapInArrow(released(run), schema)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, frames, chars, units``: every text as frames (see :class:`Frames`).

    A null text is empty and has no frame; null ids and repeated rows pass through; an empty table gives no
    rows; further columns are not read; a text of any length is kept whole.
    """
    return mapped(
        texts_of(docs, id_col, text_col),
        KEPT,
        lambda row, codec: {"doc_id": row[0].as_py()} | vars(Frames.of([row[1].as_py()], codec)),
    )


def transform(stored: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the output as frames, for every row of a store."""

    def work(row, codec):
        own, text = row
        n, form, prefix, middle, output = turn(own["doc_id"], text, rule, codec)
        return {"doc_id": own["doc_id"], "n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle} | vars(output)

    return mapped(stored, TURNED, work)


def texts(frames: DataFrame) -> DataFrame:
    """``doc_id, text`` of a store or of what :func:`transform` returns."""
    return mapped(
        frames.select("doc_id", "frames", "chars", "units"),
        "doc_id long, text string",
        lambda row, codec: {"doc_id": row[0]["doc_id"], "text": "".join(row[1].whole(codec))},
    )


def restored(turned: DataFrame) -> DataFrame:
    """``doc_id, text``: the texts as they were, from outputs and forms alone."""
    return mapped(
        turned.select("doc_id", "form", "frames", "chars", "units"),
        "doc_id long, text string",
        lambda row, codec: {"doc_id": row[0]["doc_id"], "text": "".join(restore(row[0]["form"], row[1], codec))},
    )


def round_trip(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Store, transform and restore every text: the columns of :func:`transform` with digests of both texts."""
    stored = materialize(store(docs), "frames")
    columns = "doc_id long, n long, form string, prefix_chars long, middle_chars long"

    def work(row, codec):
        own, output = row
        return own | {
            "output_sha256": digest(output.whole(codec)),
            "restored_sha256": digest(restore(own["form"], output, codec)),
        }

    return mapped(transform(stored, rule), f"{columns}, output_sha256 string, restored_sha256 string", work)
