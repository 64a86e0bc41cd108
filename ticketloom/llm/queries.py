"""Registered queries of this package, each over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.bpe import encode_and_decode
from ticketloom.llm.cotraining import classify
from ticketloom.llm.decontaminate import contamination
from ticketloom.llm.hard_negatives import hard_negatives, quantised
from ticketloom.llm.line_dedup import line_dedup
from ticketloom.llm.main_text import main_text
from ticketloom.llm.passages import passage_dedup
from ticketloom.llm.quality import quality_rules
from ticketloom.llm.simhash import simhash
from ticketloom.llm.suffix_dedup import suffix_dedup
from ticketloom.llm.token_alignment import token_alignment
from ticketloom.llm.token_counts import token_counts
from ticketloom.llm.warc import archived_pages
from ticketloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where this machine keeps the public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(_documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def op5_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup(_documents(spark, sf_dir))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(_documents(spark, sf_dir), tokenizer_path(WORD_BPE))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an empty cache, so that all the work is seen; a lasting job names a lasting path."""
    cache = scratch_path(spark, "token-counts")
    return token_counts(_documents(spark, sf_dir), tokenizer_path(BYTE_BPE), cache)


def op8_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return archived_pages(pages, scratch_path(spark, "warc"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector is an anchor; every seventh row's label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), label.alias("label"), quantised("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(_documents(spark, sf_dir), tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_passage_dedup": op5_passage_dedup,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_token_counts": op7_token_counts,
    "op8_warc_archives": op8_warc_archives,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_alignment": op12_token_alignment,
    "op13_main_text": op13_main_text,
    "pipeline": pipeline,
}

_OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bi AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + 9), ' ') AS g FROM bi),
ks AS (SELECT DISTINCT k FROM bw),
di AS (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k),
dw AS (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM di),
h AS (SELECT DISTINCT doc_id, i, dw.k AS k, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
p AS (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS pos FROM h),
cov AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM p GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

_OP8 = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

_OP11 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
  positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES: dict[str, str] = {
    "op8_warc_archives": _OP8,
    "op10_benchmark_decontamination": _OP10,
    "op11_hard_negatives": _OP11,
}
