"""Registered queries: tokens, n-grams, TF-IDF, categories, split, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.constants import CATEGORY_COLUMNS, INCIDENT_NUMBER
from ticketloom.functions.text import tokens
from ticketloom.operators import features as ft
from ticketloom.operators import filters
from ticketloom.operators.joins import heavy_hitter_join
from ticketloom.operators.models import class_table
from ticketloom.operators.ranking import class_join, folds, stratified_split
from ticketloom.plans import clean
from ticketloom.registry import oracle as o
from ticketloom.registry.catalog import query
from ticketloom.registry.cleaning import agents, tickets_table
from ticketloom.session import materialise

MULTI, OMV, ORIGINE = (ft.TEXT_CONFIGS[k] for k in ("multi", "omv", "origine"))


def grams_of(config: ft.TextConfig, source: str = "clean") -> str:
    return o.grams(config.low, config.high, config.stop_words, config.accents, source)


def text_ctes(config: ft.TextConfig, fit: str = "SELECT * FROM clean") -> dict[str, str]:
    """CTEs up to `weights`, fitted and transformed on the tickets of `fit`."""
    return {
        "docs": fit,
        "grams": grams_of(config, "docs"),
        "counts": o.COUNTS,
        "vocab": o.vocab(config.min_df, config.max_features),
        "weights": o.WEIGHTS,
    }


def fitted_vocabulary(tickets: DataFrame, config: ft.TextConfig) -> DataFrame:
    """(term, df, ctf, idf), at most max_features rows, written once."""
    vocab = ft.vocabulary(ft.term_counts(tickets, config), config)
    return materialise(ft.with_idf(vocab, tickets.count()), "vocab")


def weights_of(tickets: DataFrame, config: ft.TextConfig, vocab: DataFrame | None = None) -> DataFrame:
    vocab = fitted_vocabulary(tickets, config) if vocab is None else vocab
    return ft.tfidf(ft.term_counts(tickets, config), vocab, config.max_features)


@query("c16_tokens", o.sql(
    f"""SELECT incident_id, array_to_string(list_sort(list(w || '#' || i)), ' ') AS words FROM (
      SELECT incident_id, w, row_number() OVER (PARTITION BY incident_id ORDER BY i) AS i FROM (
       SELECT incident_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM (
        SELECT incident_id, regexp_extract_all(strip_accents(lower(description)), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM clean)))
     GROUP BY incident_id""", "clean"))
def token_rows(spark, sf):
    """Accent-free words of each ticket with their place."""
    words = tokens(F.col("description"), accents=False)
    placed = F.transform(words, lambda w, i: F.concat(w, F.lit("#"), (i + 1).cast("string")))
    return tickets_table(spark, sf).select(
        "incident_id", F.array_join(F.sort_array(placed), " ").alias("words")
    ).filter("words <> ''")


def ngram_query(name: str, config: ft.TextConfig) -> None:
    @query(name, o.sql("SELECT incident_id, term, count(*) AS tf FROM grams GROUP BY incident_id, term", "clean", grams=grams_of(config)))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return ft.term_counts(tickets_table(spark, sf), config).withColumn("tf", F.col("tf").cast("long"))


ngram_query("f1_ngrams_words_pairs", MULTI)
ngram_query("f1_ngrams_pairs_triples", OMV)


@query("a7_document_frequency", o.sql(
    "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM counts GROUP BY term", "clean",
    grams=grams_of(MULTI), counts=o.COUNTS))
def document_frequency(spark, sf):
    return ft.document_frequency(ft.term_counts(tickets_table(spark, sf), MULTI))


def vocabulary_query(name: str, config: ft.TextConfig) -> None:
    @query(name, o.sql(
        "SELECT term, df, ctf, round(idf, 6) AS idf FROM vocab", "clean",
        **{k: v for k, v in text_ctes(config).items() if k != "weights"}))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tickets = tickets_table(spark, sf)
        vocab = ft.vocabulary(ft.term_counts(tickets, config), config)
        return ft.with_idf(vocab, tickets.count()).withColumn("idf", F.round("idf", 6))


vocabulary_query("t1_vocabulary_words_pairs", MULTI)
vocabulary_query("t1_vocabulary_pairs_triples", OMV)


@query("f2_tfidf", o.sql(
    "SELECT incident_id, term, round(weight, 6) AS weight FROM weights", "clean", **text_ctes(MULTI)))
def tfidf(spark, sf):
    return weights_of(tickets_table(spark, sf), MULTI).select(
        "incident_id", "term", F.round("weight", 6).alias("weight")
    )


@query("f2_tfidf_production", o.sql(
    "SELECT incident_id, term, round(weight, 6) AS weight FROM weights", "clean", **text_ctes(ORIGINE)))
def tfidf_production(spark, sf):
    return weights_of(tickets_table(spark, sf), ORIGINE).select(
        "incident_id", "term", F.round("weight", 6).alias("weight")
    )


SPLIT = """SELECT *, rn <= ceil(CAST(0.2 AS DOUBLE) * n) AS is_test FROM (
 SELECT *, row_number() OVER (PARTITION BY omv ORDER BY md5(incident_id || '|42'), incident_id) AS rn,
  count(*) OVER (PARTITION BY omv) AS n FROM clean WHERE omv IS NOT NULL AND description <> '')"""


@query("f3_fit_on_train_only", o.sql(
    """SELECT c.incident_id, c.term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY c.incident_id)), 6) AS weight
     FROM (SELECT a.incident_id, a.term, (1.0 + ln(a.tf::DOUBLE)) * v.idf AS raw
      FROM all_counts a JOIN vocab v ON v.term = a.term) c""", "clean", split=SPLIT,
    docs="SELECT * FROM split WHERE NOT is_test", grams=grams_of(OMV, "docs"), counts=o.COUNTS,
    vocab=o.vocab(OMV.min_df, OMV.max_features), all_grams=grams_of(OMV, "split"),
    all_counts=o.COUNTS.replace("grams", "all_grams")))
def fit_on_train(spark, sf):
    """Weights of all trainable tickets under a vocabulary fitted on the train side."""
    rows = filters.trainable(tickets_table(spark, sf), "omv").select("incident_id", "omv", "description")
    split = materialise(stratified_split(rows, "omv"), "split")
    train = split.filter(~F.col("is_test"))
    return weights_of(split, OMV, fitted_vocabulary(train, OMV)).select(
        "incident_id", "term", F.round("weight", 6).alias("weight")
    )


@query("w6_norms", o.sql(
    "SELECT incident_id, round(sum(weight * weight), 6) AS length, count(*) AS terms FROM weights GROUP BY incident_id",
    "clean", **text_ctes(MULTI)))
def norms(spark, sf):
    return weights_of(tickets_table(spark, sf), MULTI).groupBy("incident_id").agg(
        F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length"), F.count("*").alias("terms")
    )


@query("j4_vocabulary_join", o.sql(
    """SELECT c.incident_id, count(*) AS known, CAST(sum(c.tf) AS BIGINT) AS occurrences
     FROM counts c JOIN vocab v ON v.term = c.term GROUP BY c.incident_id""", "clean",
    **{k: v for k, v in text_ctes(MULTI).items() if k != "weights"}))
def vocabulary_join(spark, sf):
    tickets = tickets_table(spark, sf)
    vocab = fitted_vocabulary(tickets, MULTI)
    known = ft.vocab_join(ft.term_counts(tickets, MULTI), vocab, MULTI.max_features)
    return known.groupBy("incident_id").agg(
        F.count("*").alias("known"), F.sum("tf").alias("occurrences")
    )


@query("j4_heavy_hitter_join", o.sql(
    """SELECT c.incident_id, count(*) AS known, CAST(sum(c.tf) AS BIGINT) AS occurrences
     FROM counts c JOIN vocab v ON v.term = c.term GROUP BY c.incident_id""", "clean",
    **{k: v for k, v in text_ctes(MULTI).items() if k != "weights"}))
def vocabulary_join_of_any_size(spark, sf):
    """As j4_vocabulary_join, for a vocabulary that is too large to be broadcast."""
    tickets = tickets_table(spark, sf)
    vocab = fitted_vocabulary(tickets, MULTI)
    counts = materialise(ft.term_counts(tickets, MULTI), "counts")
    return heavy_hitter_join(counts, vocab, "term").groupBy("incident_id").agg(
        F.count("*").alias("known"), F.sum("tf").alias("occurrences"))


CELLS = " UNION ALL ".join(
    f"SELECT incident_id, '{c}' AS column_name, coalesce({c}, 'INCONNU') AS value FROM clean" for c in CATEGORY_COLUMNS
)


@query("f4_one_hot", o.sql(f"SELECT incident_id, column_name, value, 1.0::DOUBLE AS weight FROM ({CELLS})", "clean"))
def one_hot(spark, sf):
    """Long one-hot form: a dictionary of every value, joined back by column and value."""
    tickets = tickets_table(spark, sf)
    dictionary = ft.category_dictionary(tickets, CATEGORY_COLUMNS)
    joined = ft.dim_join(
        ft.category_rows(tickets, CATEGORY_COLUMNS), dictionary, ["column_name", "value"],
        "inner", F.col("incident_id"),
    )
    return joined.select("incident_id", "column_name", "value", F.lit(1.0).alias("weight"))


@query("f4_category_slots", o.sql(
    f"SELECT column_name, value, count(*) AS n FROM (SELECT DISTINCT column_name, value FROM ({CELLS})) GROUP BY column_name, value", "clean"))
def category_slots(spark, sf):
    """Every value has one slot of its own: slots run from 0 without a gap or a repeat."""
    dictionary = ft.category_dictionary(tickets_table(spark, sf), CATEGORY_COLUMNS)
    total, highest, distinct = dictionary.agg(
        F.count("*"), F.max("slot") + 1, F.count_distinct("slot")
    ).first()
    whole = F.lit(1 if total == highest == distinct else 0).cast("long")
    return dictionary.select("column_name", "value", whole.alias("n"))


@query("j5_category_dictionary", o.sql(
    f"""SELECT t.incident_id, count(*) AS known FROM ({CELLS}) t JOIN (SELECT DISTINCT column_name, value FROM ({CELLS}) x
      JOIN clean c ON c.incident_id = x.incident_id WHERE c.omv IS NOT NULL) d
     ON d.column_name = t.column_name AND d.value = t.value GROUP BY t.incident_id""", "clean"))
def unseen_categories(spark, sf):
    """A dictionary fitted on labelled tickets: values unseen there give nothing."""
    tickets = tickets_table(spark, sf)
    dictionary = ft.category_dictionary(tickets.filter(F.col("omv").isNotNull()), CATEGORY_COLUMNS)
    joined = ft.dim_join(
        ft.category_rows(tickets, CATEGORY_COLUMNS), dictionary, ["column_name", "value"],
        "inner", F.col("incident_id"), small=False,
    )
    return joined.groupBy("incident_id").agg(F.count("*").alias("known"))


@query("f5_assembled_rows", o.sql(
    f"""SELECT c.incident_id, coalesce(w.n, 0) + {len(CATEGORY_COLUMNS)} AS filled,
     round(coalesce(w.total, 0) + {len(CATEGORY_COLUMNS)}, 6) AS total FROM clean c
     LEFT JOIN (SELECT incident_id, count(*) AS n, sum(weight) AS total FROM weights GROUP BY incident_id) w
      ON w.incident_id = c.incident_id""", "clean", **text_ctes(OMV)))
def assembled(spark, sf):
    """One sparse row per ticket: text weights, then one slot per category column."""
    tickets = tickets_table(spark, sf)
    model = ft.fit_features(tickets, CATEGORY_COLUMNS, OMV)
    rows = ft.transform(tickets, model)
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "incident_id", F.size("indices").cast("long").alias("filled"), F.round(total, 6).alias("total")
    )


ENTRIES = f"""SELECT incident_id, idx, round(weight, 6) AS weight FROM (
  SELECT w.incident_id, v.idx, w.weight FROM weights w
   JOIN (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab) v ON v.term = w.term
  UNION ALL SELECT x.incident_id, s.idx, 1.0 FROM ({CELLS}) x JOIN (
   SELECT column_name, value, (SELECT count(*) FROM vocab) - 1
    + row_number() OVER (ORDER BY md5(column_name || chr(31) || value), column_name || chr(31) || value) AS idx
   FROM (SELECT DISTINCT column_name, value FROM ({CELLS}))) s ON s.column_name = x.column_name AND s.value = x.value)"""


@query("f5_assembled_entries", o.sql(ENTRIES, "clean", **text_ctes(OMV)))
def assembled_entries(spark, sf):
    """Every entry of every sparse row: its index and its weight."""
    tickets = tickets_table(spark, sf)
    rows = ft.transform(tickets, ft.fit_features(tickets, CATEGORY_COLUMNS, OMV))
    entries = rows.select("incident_id", F.explode(F.arrays_zip("indices", "values")).alias("x"))
    return entries.select(
        "incident_id", F.col("x.indices").cast("long").alias("idx"), F.round("x.values", 6).alias("weight"))


@query("f5_assembled_repeated_numbers", o.sql(
    f"""SELECT c.origine_clean, count(*) AS tickets, CAST(sum(coalesce(w.n, 0) + {len(CATEGORY_COLUMNS)}) AS BIGINT) AS filled
     FROM clean c LEFT JOIN (SELECT incident_id, count(*) AS n FROM weights GROUP BY incident_id) w
      ON w.incident_id = c.incident_id GROUP BY c.origine_clean""", "clean", **text_ctes(OMV)))
def assembled_repeated_numbers(spark, sf):
    """Tickets that share five ticket numbers: every one keeps its own row."""
    raw = fixtures.incidents(spark, sf)
    number = F.pmod(F.col("incident_id"), F.lit(5)).cast("string")
    raw = raw.withColumn(INCIDENT_NUMBER, number).drop("incident_id")
    tickets = materialise(clean.clean_tickets(raw, agents(spark, sf)), "tickets")
    rows = ft.transform(tickets, ft.fit_features(tickets, CATEGORY_COLUMNS, OMV), "origine_clean")
    return rows.groupBy("origine_clean").agg(
        F.count("*").alias("tickets"), F.sum(F.size("indices")).alias("filled"))


@query("f6_stratified_split", o.sql("SELECT incident_id, omv, is_test FROM split", "clean", split=SPLIT))
def split(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "omv").select("incident_id", "omv")
    return stratified_split(rows, "omv")


@query("f6_largest_remainder", o.sql(
    """SELECT incident_id, omv, row_number() OVER (PARTITION BY omv ORDER BY md5(incident_id || '|42'), incident_id) <= quota AS is_test
     FROM clean JOIN quota USING (omv) WHERE description <> ''""", "clean", quota="""
     SELECT omv, m * n // total + CASE WHEN row_number() OVER (ORDER BY m * n % total DESC, omv)
       <= m - sum(m * n // total) OVER () THEN 1 ELSE 0 END AS quota
     FROM (SELECT *, CAST(ceil(0.2 * total) AS HUGEINT) AS m FROM (
       SELECT omv, CAST(count(*) AS HUGEINT) AS n, CAST(sum(count(*)) OVER () AS HUGEINT) AS total
       FROM clean WHERE omv IS NOT NULL AND description <> '' GROUP BY omv))"""))
def exact_split(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "omv").select("incident_id", "omv")
    return stratified_split(rows, "omv", exact=True)


@query("w5_split_quota", o.sql(
    "SELECT omv, count(*) AS n, count(*) FILTER (is_test) AS n_test FROM split GROUP BY omv", "clean", split=SPLIT))
def split_quota(spark, sf):
    return split(spark, sf).groupBy("omv").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("n_test")
    )


@query("e4_folds", o.sql(
    """SELECT incident_id, omv, CAST(row_number() OVER (PARTITION BY omv ORDER BY md5(incident_id || '|42'), incident_id) % 5 AS INT) AS fold
     FROM clean WHERE omv IS NOT NULL AND description <> ''""", "clean"))
def fold_rows(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "omv").select("incident_id", "omv")
    return folds(rows, "omv", 5)


@query("f7_label_codes", o.sql(
    """SELECT incident_id, origine_clean, CAST(dense_rank() OVER (ORDER BY origine_clean) - 1 AS INT) AS cls
     FROM clean WHERE origine_clean IS NOT NULL""", "clean"))
def label_codes(spark, sf):
    rows = tickets_table(spark, sf).select("incident_id", "origine_clean").filter("origine_clean IS NOT NULL")
    return class_join(rows, class_table(rows, "origine_clean").select("origine_clean", "cls"), "origine_clean", "inner")


@query("f8_class_weights", o.sql(
    """SELECT service_clean, n, round(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n), 6) AS weight FROM (
      SELECT service_clean, count(*) AS n FROM clean WHERE service_clean IS NOT NULL GROUP BY service_clean)""", "clean"))
def class_weights(spark, sf):
    rows = tickets_table(spark, sf).filter("service_clean IS NOT NULL")
    return class_table(rows, "service_clean").select("service_clean", "n", F.round("weight", 6).alias("weight"))
