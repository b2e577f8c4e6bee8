"""One registered query per operator, over whole tables with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geomart.llm import (
    alignment,
    bpe,
    compression,
    decontaminate,
    frames,
    lattice,
    licenses,
    neardup,
    repeats,
    secrets,
    syncmers,
    tokenfiles,
    warc,
)
from geomart.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document by the ranks of a byte-level BPE."""
    import public_tokenizers

    return bpe.digests(
        read(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words of the benchmark items in every document."""
    return decontaminate.flag(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op10_lattice_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, by words and over all subword segmentations."""
    return lattice.score(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of every document from its sizes under two dictionaries."""
    return compression.predict(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op1_secrets")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the rules' hits and what the random field adds."""
    return secrets.scan(read(spark, sf_dir, "documents"))


@query(
    "op3_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
    ), q AS (
      SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
        CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS smallest FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN smallest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CAST(CASE WHEN smallest <> page_id THEN smallest END AS DOUBLE) AS refers_to FROM q
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("url")


@query("op5_neardup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are similar."""
    return neardup.cluster(read(spark, sf_dir, "documents"))


@query("op9_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier document holds in a run of 50 or more."""
    return repeats.summary(read(spark, sf_dir, "documents"))


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to compressed files and read back."""
    return tokenfiles.round_trip(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprints of every document and its edited text."""
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


@query("op11_licenses")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notice phrases and evaluated licence expressions in every document."""
    return licenses.summary(read(spark, sf_dir, "documents"))


@query(
    "op12_fill_in_middle",
    """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines,
        sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
    ), c AS (
      SELECT *, CASE WHEN t = '' THEN 0 WHEN right(t, 1) = chr(10) THEN len(lines) - 1 ELSE len(lines) END AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
    ), u AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c
    ), k AS (
      SELECT *, least(length(t), a + coalesce(length(array_to_string(lines[1:a], '')), 0)) AS p,
        least(length(t), b + coalesce(length(array_to_string(lines[1:b], '')), 0)) AS q FROM u
    ), s AS (
      SELECT *, substr(t, 1, p) AS prefix, substr(t, p + 1, q - p) AS middle, substr(t, q + 1) AS suffix FROM k
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
      CAST(CASE WHEN form <> 'plain' THEN p END AS BIGINT) AS prefix_chars,
      CAST(CASE WHEN form <> 'plain' THEN q - p END AS BIGINT) AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
             ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256 FROM s
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, stored in frames and restored from them."""
    return frames.round_trip(read(spark, sf_dir, "documents"))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two vocabularies in every document, and how common they are."""
    docs = read(spark, sf_dir, "documents")
    return alignment.summary(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
