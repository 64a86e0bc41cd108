"""Token counts with a cache by content.

The cache is a table of (digest of the text, digest of the tokenizer file, count). Texts are
reduced to their distinct digests with a map-side step, those that the cache knows are taken out,
and only the rest is encoded and appended. Another tokenizer version has another digest, so its
counts never mix with older ones.

Within a task the same idea holds for the units of text between blanks: a byte-level tokenizer
never joins a blank to the character before it, so a text's count is the sum over its units.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, columns_of, shipped, unpacked, utf8

LIMIT = 1024
CACHED = 400_000

_BLANK_RUN = re.compile(r" \s")
_BLANK = re.compile(r" (?=\S)")
_CACHE = "content_digest binary, tokenizer_digest string, n_tokens long"


class Counter:
    """Counts a text's tokens as the library for the tokenizer file gives them."""

    def __init__(self, name: str, content: bytes) -> None:
        self.name, self.content = name, content
        self.digest = hashlib.sha256(content).hexdigest()
        self.by_unit = False
        if name.endswith(".json"):
            spec = json.loads(content)
            before = spec["pre_tokenizer"] or {}
            self.by_unit = not spec["normalizer"] and before.get("type") == "ByteLevel" and bool(
                before.get("use_regex")) and not before.get("add_prefix_space")
        self.library = None
        self.units: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "library": None, "units": {}}

    def _lengths(self, texts: list[str]) -> list[int]:
        if self.name.endswith(".model"):
            if self.library is None:
                import sentencepiece

                self.library = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return list(map(len, self.library.encode(texts, num_threads=1)))
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            import tokenizers

            self.library = tokenizers.Tokenizer.from_str(self.content.decode())
            self.library.no_truncation()
            self.library.no_padding()
        return list(map(len, self.library.encode_batch_fast(texts, add_special_tokens=False)))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_unit:
            return self._lengths(texts)
        firsts, rests = [], []
        for text in texts:
            units = _BLANK.split(text) if _BLANK_RUN.search(text) else text.split(" ")
            firsts.append(units[0])
            rests.append(units[1:])
        totals = self._lengths(firsts)
        for at, rest in enumerate(rests):
            known = self.units
            new = list({u for u in rest if u not in known})
            if len(known) + len(new) > CACHED:
                known.clear()
                new = list(set(rest))
            if new:
                known.update(zip(new, self._lengths([" " + u for u in new])))
            totals[at] += sum(map(known.__getitem__, rest))
        return totals


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = unpacked(shared)
        for batch in batches:
            digests, texts = columns_of(batch, "content_digest", "text")
            found = counter.counts([t.decode("utf-8", "replace") for t in texts])
            yield pa.RecordBatch.from_pydict({
                "content_digest": pa.array(digests, pa.binary()),
                "tokenizer_digest": pa.array([counter.digest] * len(found)),
                "n_tokens": pa.array(found, pa.int64())})

    return count


def _cached(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """The cache's counts for one tokenizer, one for each digest."""
    try:
        rows = spark.read.schema(_CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _CACHE)
    return rows.where(F.col("tokenizer_digest") == tokenizer).groupBy("content_digest").agg(
        F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of `docs`; `cache_path` is extended.

    The library's defaults hold for special strings in texts; nothing is added, cut or padded. A
    null text counts as empty: no bytes, no tokens. The content that is digested is the text's
    UTF-8, so texts that differ in any way are different entries. Rows with null or repeated ids
    keep their rows. Columns besides `doc_id` and `text` are not read. A task that is run again
    writes its part again, never beside it, and entries that two runs both append are equal.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, "rb") as file:  # a few MB, whatever the corpus
        counter = Counter(os.path.basename(tokenizer_path), file.read())
    text = utf8("text")
    digest = F.unhex(F.sha2(text, 256))
    distinct = docs.select(digest.alias("content_digest"), text.alias("text")).groupBy("content_digest").agg(
        F.first("text").alias("text"))
    misses = distinct.join(_cached(spark, cache_path, counter.digest), "content_digest", "left_anti")
    misses.mapInArrow(_counter(shipped(spark, counter)), _CACHE).write.mode("append").parquet(cache_path)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
        digest.alias("content_digest"))
    return rows.join(_cached(spark, cache_path, counter.digest), "content_digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
