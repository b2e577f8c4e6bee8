"""Document fingerprints from closed syncmers, in DataFrame functions only.

The symbols of a text are its words (runs without white space). A run of more than 24 characters, as in languages
without spaces, has a symbol at each of its characters: this and the next seven, so that no cut depends on where
the run begins. A k-mer of five words is chosen if the smallest of its four two-word substrings, by hash, is
its first or its last. Whether it is chosen depends on its five symbols alone, so an edit changes the
choice only where it happens. About half of the k-mers are chosen, and the fingerprint has all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomart.llm.common import texts_of
from geomart.session import materialize

#: A word, or a character of a longer run; group 1 is its symbol.
WORD = r"(?=((?<!\S)\S{1,24}(?!\S)|\S{1,8}))(?:(?<!\S)\S{1,24}(?!\S)|\S)"


def shifted(values: Column, by: int) -> Column:
    """The array from its element ``by`` on."""
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def with_places(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: ``(hash, at)`` of each closed syncmer of ``text`` in its order; ``at`` is the number of its first symbol.

    A text of fewer than five symbols, or without a closed syncmer, has the hash of all of them at 0; a text without words
    has none. Each step is a column of its own, so that no array is made twice.
    """
    df = df.withColumn("__h", F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(1)), lambda w: F.xxhash64(w)))
    df = df.withColumn("__two", F.slice(F.zip_with("__h", shifted(F.col("__h"), 1), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.size("__h") - 1, F.lit(0))))
    two = F.col("__two")
    df = df.withColumn("__k", F.arrays_zip(two.alias("a"), shifted(two, 1).alias("b"), shifted(two, 2).alias("c"), shifted(two, 3).alias("d")))

    def place(x: Column, i: Column) -> Column:
        # the last three have no fifth word: their d is null, and so is the comparison
        closed = x["d"].isNotNull() & (F.least(x["a"], x["d"]) <= F.least(x["b"], x["c"]))
        return F.when(closed, F.struct(F.xxhash64(x["a"], x["c"], x["d"]).alias("hash"), i.alias("at")))

    df = df.withColumn("__chosen", F.array_compact(F.transform("__k", place)))
    whole = F.slice(F.array(F.struct(F.xxhash64("__h").alias("hash"), F.lit(0).alias("at"))), 1, F.least(F.size("__h"), F.lit(1)))
    df = df.withColumn(out, F.when(F.size("__chosen") > 0, F.col("__chosen")).otherwise(whole))
    return df.drop("__h", "__two", "__k", "__chosen")


def anchors_of(places: str) -> Column:
    """Sorted distinct upper halves of the hashes."""
    return F.sort_array(F.array_distinct(F.transform(places, lambda p: F.shiftright(p["hash"], 32).cast("int"))))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: sorted distinct hashes of all closed syncmers of ``text``."""
    return with_places(df, text, "__places").withColumn(out, anchors_of("__places")).drop("__places")


def as_text(anchors: str) -> Column:
    """Eight hexadecimal digits of each anchor."""
    low = F.transform(anchors, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0"))
    return F.lower(F.array_join(low, ""))


def likeness(a: str, b: str) -> Column:
    """Share of common anchors among all anchors of both; 1 if neither has any."""
    common = F.array_size(F.array_intersect(a, b))  # null if one is null, whatever the session's settings
    both = F.array_size(a) + F.array_size(b) - common  # anchors are distinct
    return F.when(both == 0, F.lit(1.0)).otherwise(common / both)


def neighbours(texts: DataFrame) -> DataFrame:
    """``doc_id, before, need``: for each id the next higher one (for the highest the lowest), and half its length.

    ``doc_id`` is the next document of ``before`` in descending order. Ids are cut into ranges
    that are written once; within a range a window gives the neighbour, and between
    ranges only one row of each is looked at.
    """
    ids = texts.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("chars"))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = materialize(ids.repartitionByRange(parts, "doc_id").withColumn("range", F.spark_partition_id()), "id-ranges")
    above = Window.partitionBy("range").orderBy("doc_id")
    inner = ids.select(
        "doc_id", "range", F.lead("doc_id").over(above).alias("before"), F.lead("chars").over(above).alias("chars")
    )
    # the first row of each range follows the last one of the range below; one row per range
    first = ids.groupBy("range").agg(F.min_by(F.struct("doc_id", "chars"), "doc_id").alias("first"))
    order = Window.orderBy("range")
    lowest = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = first.select("range", F.coalesce(F.lead("first").over(order), lowest).alias("first"))
    joined = inner.join(F.broadcast(first), "range")  # a row per range
    return joined.select(
        "doc_id",
        F.coalesce("before", F.col("first.doc_id")).alias("before"),
        F.floor(F.coalesce("chars", F.col("first.chars")) / 2).cast("int").alias("need"),
    )


def passages(left: DataFrame, right: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``left_id, right_id, offset, n, first, last``: anchors that two texts share, by the offset of their places.

    All pairs of a left and a right document that share an anchor are there, each with every offset (place in the right
    text less place in the left one) at which anchors meet: ``n`` of them, the first and last at these symbols of the left
    text. A passage that moved has one offset; paragraphs in another order have one each. No anchor is left out for being frequent,
    so an anchor with a places on the left and b on the right is a x b rows of the join before they are
    counted. Rows with a null id are left out; of rows that repeat an id the smallest text counts.
    """

    def places(docs: DataFrame, side: str) -> DataFrame:
        texts = texts_of(docs, id_col, text_col).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("text").alias("text"))
        each = with_places(texts, "text", "places").select("doc_id", F.inline("places"))
        return each.toDF(f"{side}_id", "hash", f"{side}_at")

    joined = places(left, "left").join(places(right, "right"), "hash")
    return joined.groupBy("left_id", "right_id", (F.col("right_at") - F.col("left_at")).alias("offset")).agg(
        F.count("*").alias("n"), F.min("left_at").alias("first"), F.max("left_at").alias("last")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next document in descending
    order of ids (after the last: the first). A null text is empty; of rows that repeat an id, the one with
    the smallest text is "the next document" for others, and each comes back; rows with a
    null id have no next document: their edited text is their text without its last half,
    and ``near_next`` is null. ``places`` and ``edited_places`` hold each anchor's hash and symbol
    number in the order of the text; fingerprints and likeness derive from them. An empty table gives no rows; further columns are not read.
    """
    texts = texts_of(docs, id_col, text_col)
    named = texts.where("doc_id IS NOT NULL")
    order = neighbours(named)
    # The same texts, dealt by id, serve both joins, so they are shuffled once. Anchors come after it:
    # Spark doesn't see that two plans with lambdas are equal.
    own = with_places(named.repartition("doc_id"), "text", "places")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    following = own.join(order, "doc_id").withColumn("rank", rank).where("rank = 1")
    following = following.select(
        F.col("before").alias("doc_id"), F.expr("substring(text, 1, need)").alias("begin"), anchors_of("places").alias("next_anchors")
    )
    alone = with_places(texts.where("doc_id IS NULL"), "text", "places")
    nothing = (F.lit(None).cast("string").alias("begin"), F.lit(None).cast("array<int>").alias("next_anchors"))
    own = own.join(following, "doc_id").select("doc_id", "text", "places", "begin", "next_anchors")
    own = own.unionAll(alone.select("doc_id", "text", "places", *nothing))
    half = F.floor(F.char_length("text") / 2).cast("int")
    df = own.withColumn("n_chars", F.char_length("text").cast("long"))
    df = df.withColumn("half", half).withColumn(
        "edited",
        F.concat(F.expr("substring(text, 1, cast(n_chars as int) - half)"), F.expr("substring(coalesce(begin, ''), 1, half)")),
    )
    df = df.select("doc_id", "n_chars", "places", anchors_of("places").alias("anchors"), "next_anchors", "edited", F.sha2("edited", 256).alias("edited_sha256"))
    df = with_places(df, "edited", "edited_places").drop("edited").withColumn("edited_anchors", anchors_of("edited_places"))
    return df.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"),
        likeness("anchors", "next_anchors").alias("near_next"),
        "places",
        "edited_places",
    )
