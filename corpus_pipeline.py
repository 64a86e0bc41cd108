"""The corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes all rows that the one before kept, as a table, and returns its own. run() applies
them to `documents`; a cluster keeps the tables between stages below spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm.bpe import encode_and_decode
from ticketloom.llm.decontaminate import drop_contaminated
from ticketloom.llm.line_dedup import drop_repeated_lines
from ticketloom.llm.quality import drop_low_quality
from ticketloom.llm.queries import WORD_BPE, tokenizer_path
from ticketloom.llm.simhash import drop_near_duplicates
from ticketloom.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and their language's perplexity band accept."""
    return drop_low_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that nearly repeat an earlier one; see drop_repeated_lines."""
    return drop_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return encode_and_decode(docs, tokenizer_path(WORD_BPE))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

# SQL expresses neither the language model nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
