"""Sparse text and category features.

Long form `(incident_id, term, weight)` for SQL work; array form
`(indices, values)` with one row per ticket for training and scoring.

Terms are counted inside each row. Only known terms, packed to one row per
ticket before they travel, are shuffled.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.constants import STOP_WORDS, UNKNOWN
from ticketloom.functions.text import bind, term_frequencies, tokens
from ticketloom.operators.joins import BROADCAST_ROWS, dim_join, heavy_hitter_join, is_small
from ticketloom.operators.ranking import rank_in_group
from ticketloom.operators.vectorise import Lookup, vectorise
from ticketloom.session import materialise, scratch_path

ID = "incident_id"
# A vocabulary is capped by `max_features`; up to this cap it is safe to broadcast.
MAX_BROADCAST_TERMS = 1_000_000


@dataclass(frozen=True)
class TextConfig:
    """How a description becomes terms."""

    low: int = 1
    high: int = 2
    min_df: int = 2
    max_features: int = 5000
    accents: bool = True  # False strips them
    stop_words: bool = True


# --- Fixed values: text settings per pipeline ---------------------------------
TEXT_CONFIGS = {
    "omv": TextConfig(2, 3, 2, 8000, accents=False, stop_words=False),
    "origine": TextConfig(1, 2, 2, 20000, accents=False, stop_words=False),
    "binary": TextConfig(1, 2, 3, 5000),
    "cascade_omv": TextConfig(1, 2, 3, 5000),
    "multi": TextConfig(1, 2, 2, 5000),
}


def term_counts(tickets: DataFrame, config: TextConfig, *keep: str) -> DataFrame:
    """(incident_id, *keep, term, tf). Counted inside each row, so nothing is shuffled."""
    stop_words = STOP_WORDS if config.stop_words else None
    terms = term_frequencies(
        F.col("description"), config.low, config.high, config.accents, stop_words
    )
    return tickets.select(ID, *keep, F.inline(terms))


def document_frequency(counts: DataFrame) -> DataFrame:
    """(term, df, ctf). Hot terms shrink map-side; `counts` has one row per ticket and term."""
    return counts.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ctf")
    )


def vocabulary(counts: DataFrame, config: TextConfig) -> DataFrame:
    """(term, df, ctf) of the most frequent terms; ties in term order.

    The number of terms by frequency tells which frequency the cut falls on; only terms at least so
    frequent, little more than `max_features`, are sorted.
    """
    frequent = materialise(document_frequency(counts).filter(F.col("df") >= config.min_df), "frequencies")
    sizes = frequent.groupBy("ctf").agg(F.count("*").alias("n"))  # one row a distinct frequency
    above = Window.orderBy(F.desc("ctf")).rowsBetween(Window.unboundedPreceding, -1)
    lowest = sizes.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0))).filter(
        F.col("above") < config.max_features).agg(F.min("ctf")).first()[0]
    return frequent.filter(F.col("ctf") >= F.lit(0 if lowest is None else lowest)).orderBy(
        F.desc("ctf"), "term").limit(config.max_features)


def with_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed inverse document frequency: ln((1 + N) / (1 + df)) + 1."""
    return vocab.withColumn(
        "idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    )


def vocab_join(counts: DataFrame, vocab: DataFrame, max_features: int) -> DataFrame:
    """Keep known terms; a vocabulary of at most MAX_BROADCAST_TERMS is broadcast, of a larger one
    the frequent terms are."""
    if max_features <= MAX_BROADCAST_TERMS:
        return counts.join(F.broadcast(vocab), "term")
    return heavy_hitter_join(materialise(counts, "counts"), vocab, "term")


def raw_weight():
    """(1 + ln tf) * idf."""
    return (F.log(F.col("tf").cast("double")) + 1.0) * F.col("idf")


def unit_length(pairs):
    """array<struct<idx, raw>> scaled to length one, as array<struct<idx, weight>>."""
    norm = F.sqrt(F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x["raw"] * x["raw"]))
    return bind(
        norm,
        lambda length: F.transform(
            pairs, lambda x: F.struct(x["idx"].alias("idx"), (x["raw"] / length).alias("weight"))
        ),
    )


def tfidf(counts: DataFrame, vocab: DataFrame, max_features: int) -> DataFrame:
    """Add `weight` = (1 + ln tf) * idf, scaled to unit length per ticket."""
    raw = vocab_join(counts, vocab, max_features).withColumn("_raw", raw_weight())
    # The rows of one window are one ticket's distinct terms, at most max_features.
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(ID)))
    return raw.withColumn("weight", F.col("_raw") / norm).drop("_raw")


# ---------------------------------------------------------------------------
# Categories
# ---------------------------------------------------------------------------

def category_rows(tickets: DataFrame, columns: list[str]) -> DataFrame:
    """(incident_id, column_name, value), one row per category column; null is unknown."""
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"),
        )
        for c in columns
    ]
    return tickets.select(ID, F.inline(F.array(*cells)))


def category_dictionary(tickets: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, slot): every distinct value gets a slot 0..n-1."""
    values = category_rows(tickets, columns).groupBy("column_name", "value").agg(
        F.count("*").alias("n")
    )
    key = F.concat_ws("\x1f", "column_name", "value")
    ranked = rank_in_group(values.withColumn("_key", key), [], F.md5("_key"), "_key")
    return ranked.select("column_name", "value", (F.col("rn") - 1).cast("int").alias("slot"))


# ---------------------------------------------------------------------------
# Feature model
# ---------------------------------------------------------------------------

@dataclass
class FeatureModel:
    """A fitted vocabulary and category dictionary.

    Text terms take feature indices 0..n_terms-1, categories the rest.
    """

    config: TextConfig
    columns: list[str]
    vocab: DataFrame = field(repr=False)  # term, df, ctf, idf, idx
    dictionary: DataFrame | None = field(repr=False)  # column_name, value, slot
    n_terms: int = 0
    n_categories: int = 0

    @property
    def size(self) -> int:
        return self.n_terms + self.n_categories

    def save(self, path: str) -> None:
        spark = self.vocab.sparkSession
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        if self.dictionary is not None:
            self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        meta = {
            "config": asdict(self.config), "columns": self.columns,
            "n_terms": self.n_terms, "n_categories": self.n_categories,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(
            TextConfig(**meta["config"]),
            meta["columns"],
            spark.read.parquet(f"{path}/vocab"),
            spark.read.parquet(f"{path}/dictionary") if meta["columns"] else None,
            meta["n_terms"],
            meta["n_categories"],
        )


def index_vocabulary(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Add idf and a term-ordered index; the vocabulary is bounded, so one window is fine."""
    return with_idf(vocab, n_docs).withColumn(
        "idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int")
    )


def fit_features(
    tickets: DataFrame,
    columns: list[str],
    config: TextConfig,
    counts: DataFrame | None = None,
    dictionary: DataFrame | None = None,
) -> FeatureModel:
    """Fit vocabulary and category dictionary on `tickets`.

    `counts` and `dictionary` may hold those of the same tickets if already made.
    """
    n_docs = tickets.count()
    counts = term_counts(tickets, config) if counts is None else counts
    vocab = materialise(index_vocabulary(vocabulary(counts, config), n_docs), "vocab")
    n_categories = 0
    if columns:
        if dictionary is None:
            dictionary = materialise(category_dictionary(tickets, columns), "categories")
        n_categories = dictionary.count()
    return FeatureModel(config, list(columns), vocab, dictionary, vocab.count(), n_categories)


def transform(
    tickets: DataFrame,
    model: FeatureModel,
    *keep: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """(incident_id, *keep, indices, values): one sparse row per ticket.

    Unknown terms and categories add nothing; a ticket without any keeps empty arrays. A vocabulary
    and a dictionary of bounded size travel to the tickets, which stay where they are. Larger ones,
    or `counts` made earlier, are joined by ticket id.
    """
    if counts is None and model.config.max_features <= MAX_BROADCAST_TERMS and model.n_categories <= BROADCAST_ROWS:
        config = model.config
        words = tokens(F.col("description"), config.accents, STOP_WORDS if config.stop_words else None)
        cells = [F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in model.columns]
        lookup = Lookup.of(model.vocab, model.dictionary, model.columns, model.n_terms)
        return vectorise(
            tickets, list(dict.fromkeys([ID, *keep])), words, config.low, config.high, cells, lookup)
    counts = term_counts(tickets, model.config) if counts is None else counts
    known = vocab_join(counts, model.vocab.select("term", "idf", "idx"), model.config.max_features)
    # One ticket's terms sit in one partition, so they collapse to one row before the shuffle.
    texts = known.groupBy(ID).agg(
        F.array_sort(F.collect_list(F.struct("idx", raw_weight().alias("raw")))).alias("_raw")
    ).select(ID, unit_length(F.col("_raw")).alias("_text"))
    base = tickets.select(ID, *keep, *[c for c in model.columns if c not in keep])
    if model.columns:
        small = is_small(model.dictionary)
        for column in model.columns:
            slots = model.dictionary.filter(F.col("column_name") == column).select(
                F.col("value").alias("_value"),
                (F.col("slot") + model.n_terms).alias(f"_slot_{column}"),
            )
            base = base.withColumn(
                "_value", F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
            )
            base = dim_join(base, slots, ["_value"], "left", F.col(ID), small).drop("_value")
        slot_pairs = F.array(
            *[
                F.struct(F.col(f"_slot_{c}").alias("idx"), F.lit(1.0).alias("weight"))
                for c in model.columns
            ]
        )
        categories = F.array_sort(F.filter(slot_pairs, lambda s: s["idx"].isNotNull()))
    else:
        categories = F.array().cast("array<struct<idx:int,weight:double>>")
    no_text = F.array().cast("array<struct<idx:int,weight:double>>")
    pairs = F.concat(F.coalesce(F.col("_text"), no_text), categories)
    return (
        base.join(texts, ID, "left")
        .select(ID, *keep, pairs.alias("_pairs"))
        .select(
            ID, *keep,
            F.col("_pairs.idx").alias("indices"),
            F.col("_pairs.weight").alias("values"),
        )
    )


def as_vectors(features: DataFrame, size: int) -> DataFrame:
    """The same rows with a Spark ML sparse vector `features`, via a written table.

    A vector column is stored as a struct, so writing that struct and reading it
    with the vector type packs it without any Python.
    """
    spark = features.sparkSession
    keep = [c for c in features.columns if c not in ("indices", "values")]
    packed = features.select(
        *keep,
        F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(size).cast("int").alias("size"),
            F.col("indices"),
            F.col("values"),
        ).alias("features"),
    )
    path = scratch_path(spark, "vectors")
    packed.write.parquet(path)
    schema = T.StructType(
        [features.schema[c] for c in keep] + [T.StructField("features", VectorUDT())]
    )
    return spark.read.schema(schema).parquet(path)
