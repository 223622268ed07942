"""The operators as named queries over their whole tables, with SQL answers.

Each query is thin: it applies one operator with its production parameters
and derives the columns of its result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.llm import (
    alignment,
    byte_bpe,
    chosen_path,
    fertility,
    hard_negatives,
    licenses,
    main_text,
    multiprobe,
    packing,
    substring_dedup,
    token_counts,
    toxicity,
    warc,
)
from proclivity.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabularies of the fertility measures: pieces with byte fallback, and
#: ranks for many languages.
VOCABULARIES = (
    public_tokenizers.path("piece_bpe_32k.model"),
    public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
#: Vocabulary that sequences are packed by.
PACKED_BY = public_tokenizers.path("byte_bpe_50k.json")
#: Vocabularies whose tokens are aligned.
ALIGNED = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("piece_bpe_32k.model"),
)
#: Vocabulary that tokens are counted by.
COUNTED_BY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        F.col("doc_id").cast("long"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces_of(docs, PACKED_BY))


@query
def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rate(table(spark, sf_dir, "documents"), *VOCABULARIES)


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op8_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op8_warc_members"] = """
WITH b AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (
  SELECT page_id, url, html, sha1(html) AS digest,
         max(page_id) OVER (PARTITION BY html) AS last
  FROM b),
bits AS (
  SELECT page_id, url, html, last,
    [list_position(
       ['0','1','2','3','4','5','6','7','8','9','a','b','c','d','e','f'],
       digest[i]) - 1 FOR i IN range(1, 41)] AS nibbles
  FROM h)
SELECT page_id, url, strlen(html) AS payload_bytes,
  array_to_string([
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      (((nibbles[(5 * k) // 4 + 1] * 256
         + coalesce(nibbles[(5 * k) // 4 + 2], 0) * 16
         + coalesce(nibbles[(5 * k) // 4 + 3], 0))
        // (1 << (7 - (5 * k) % 4))) % 32 + 1)::INT]
    FOR k IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM bits
"""


@query
def op9_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.nearest(table(spark, sf_dir, "embeddings"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own, so each run encodes all distinct texts
    return token_counts.count(
        table(spark, sf_dir, "documents"),
        COUNTED_BY,
        scratch(spark, "token-counts"),
    )


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *ALIGNED)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_inner_product(a.x, v.x) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (
    PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id,
    score AS negative_score, CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id
      ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score
    AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score,
  negative_score
FROM n WHERE rank <= 10
"""


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS passage FROM starts),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY passage) AS n FROM windows)
  WHERE n > 1),
words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
marked AS (
  SELECT w.doc_id, w.i, w.word, max(t.i) OVER (
    PARTITION BY w.doc_id ORDER BY w.i
    ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words w LEFT JOIN twice t ON t.doc_id = w.doc_id AND t.i = w.i),
done AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN done ON done.doc_id = d.doc_id
"""
