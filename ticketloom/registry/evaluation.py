"""Registered queries: evaluation of prediction tables, tuning rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.constants import NGRAM_GRID
from ticketloom.operators import evaluate, filters
from ticketloom.plans import tuning
from ticketloom.registry import oracle as o
from ticketloom.registry.catalog import query
from ticketloom.registry.cleaning import tickets_table


def binary(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.run(spark, sf, fixtures.BINARY)


def multi(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.run(spark, sf, fixtures.MULTI)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


PER_CLASS = """SELECT c AS class, count(*) FILTER (y = c AND p = c) AS tp, count(*) FILTER (y = c) AS support,
  count(*) FILTER (p = c) AS pred FROM multi_pred, (SELECT y AS c FROM multi_pred UNION SELECT p FROM multi_pred) GROUP BY c"""
REPORT = """SELECT class, support, tp, CASE WHEN pred = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / pred END AS precision,
  CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / support END AS recall,
  CASE WHEN support + pred = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * tp / (support + pred) END AS f1 FROM per_class"""


@query("e1_accuracy", o.sql("SELECT round(avg((y = p)::INT), 6) AS accuracy FROM multi_pred", "multi_pred"))
def accuracy(spark, sf):
    return rounded(evaluate.accuracy(multi(spark, sf)), "accuracy")


@query("e2_f1_scores", o.sql(
    """SELECT round(sum(tp)::DOUBLE / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
     round(sum(f1 * support) / sum(support), 6) AS f1_weighted, CAST(sum(support) AS BIGINT) AS n FROM report""",
    "multi_pred", per_class=PER_CLASS, report=REPORT))
def f1_scores(spark, sf):
    return rounded(evaluate.summary(multi(spark, sf)), "accuracy", "f1_macro", "f1_weighted")


@query("e3_roc_auc", o.sql(
    """SELECT round((sum(r) FILTER (y = 1) - p * (p + 1) / 2) / (p * q), 6) AS auc FROM (
      SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r,
       sum(y) OVER ()::DOUBLE AS p, sum(1 - y) OVER ()::DOUBLE AS q FROM binary_pred) GROUP BY p, q""", "binary_pred"))
def auc(spark, sf):
    return rounded(evaluate.roc_auc(binary(spark, sf)), "auc")


@query("e5_binary_counts", o.sql(
    """SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
     count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp FROM binary_pred""", "binary_pred"))
def binary_counts(spark, sf):
    return evaluate.binary_counts(binary(spark, sf))


@query("e5_confusion_matrix", o.sql("SELECT y, p, count(*) AS n FROM multi_pred GROUP BY y, p", "multi_pred"))
def confusion(spark, sf):
    return evaluate.confusion(multi(spark, sf))


@query("e6_class_report", o.sql(
    """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, f1 < 0.5 AS is_weak FROM report
     UNION ALL SELECT 'accuracy', round(sum(tp)::DOUBLE / sum(support), 6), round(sum(tp)::DOUBLE / sum(support), 6),
      round(sum(tp)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT), NULL FROM report
     UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT), NULL FROM report
     UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT), NULL FROM report""",
    "multi_pred", per_class=PER_CLASS, report=REPORT))
def class_report(spark, sf):
    return rounded(evaluate.full_report(multi(spark, sf)), "precision", "recall", "f1")


@query("t5_report_by_support", o.sql(
    """SELECT class, round(f1, 6) AS f1, support, row_number() OVER (ORDER BY support DESC, class) AS place FROM report""",
    "multi_pred", per_class=PER_CLASS, report=REPORT))
def report_by_support(spark, sf):
    from pyspark.sql import Window

    report = evaluate.by_support(evaluate.class_report(evaluate.confusion(multi(spark, sf))))
    place = F.row_number().over(Window.orderBy(F.desc("support"), "class"))  # one row a class
    return report.select("class", F.round("f1", 6).alias("f1"), "support", place.cast("long").alias("place"))


@query("e7_frequent_confusions", o.sql(
    "SELECT y, p, count(*) AS n FROM multi_pred WHERE y <> p GROUP BY y, p HAVING count(*) > 5", "multi_pred"))
def frequent_confusions(spark, sf):
    return evaluate.frequent_confusions(multi(spark, sf))


# --- rankings of settings -----------------------------------------------------------------
# Three threshold rules stand in for the classifiers, so that every setting's
# quality is an aggregate over all labelled tickets and the ranking can be checked.

RULES = [
    (position, name, threshold)
    for position, (name, threshold) in enumerate(
        [("length", t) for t in (200, 800, 1600, 3200)]
        + [("urgency", t) for t in (1, 2, 3, 4)]
        + [("requester", t) for t in (8, 16, 20, 21)]
    )
]
NGRAMS = [
    (i, low, high, size, c)
    for i, ((low, high), size, c) in enumerate(
        (r, m, c) for r in NGRAM_GRID["ngram_range"] for m in NGRAM_GRID["max_features"] for c in NGRAM_GRID["C"]
    )
]


def graded(df: DataFrame, names: list[str]) -> DataFrame:
    """Accuracy and macro F1 per setting, from one pass over ticket x setting rows."""
    return evaluate.summary(df, *names).select(*names, F.round("accuracy", 6).alias("accuracy"), F.round("f1_macro", 6).alias("f1_macro"))


def rule_results(spark: SparkSession, sf: str) -> DataFrame:
    tickets = filters.trainable(tickets_table(spark, sf), "omv")
    settings = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("classifier"), F.lit(t).alias("threshold")) for i, n, t in RULES
    ])
    measure = F.when(F.col("classifier") == "length", F.length("description")).when(
        F.col("classifier") == "urgency", F.col("urgence_num").cast("int")
    ).otherwise(F.length("demandeur"))
    tried = tickets.select("*", F.inline(settings)).select(
        "position", "classifier", "threshold", F.col("omv").alias("y"),
        F.when(measure >= F.col("threshold"), "OUI").otherwise("NON").alias("p"),
    )
    return graded(tried, ["position", "classifier", "threshold"])


def ngram_results(spark: SparkSession, sf: str) -> DataFrame:
    tickets = filters.trainable(tickets_table(spark, sf), "omv")
    settings = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(a).alias("low"), F.lit(b).alias("high"),
            F.lit(m).alias("max_features"), F.lit(c).alias("c"),
        ) for i, a, b, m, c in NGRAMS
    ])
    points = F.length("description") * (F.col("low") + 2 * F.col("high")) % F.floor(F.col("max_features") / 1000)
    tried = tickets.select("*", F.inline(settings)).select(
        "position", "low", "high", "max_features", "c", F.col("omv").alias("y"),
        F.when(points * F.col("c") >= 1.0, "OUI").otherwise("NON").alias("p"),
    )
    return graded(tried, ["position", "low", "high", "max_features", "c"])


def results_sql(values: str, columns: str, predicted: str) -> dict[str, str]:
    return {
        "tried": f"""SELECT {columns}, omv AS y, CASE WHEN {predicted} THEN 'OUI' ELSE 'NON' END AS p
          FROM clean, (VALUES {values}) s({columns}) WHERE omv IS NOT NULL AND description <> ''""",
        "results": f"""SELECT {columns}, round(any_value(acc), 6) AS accuracy, round(avg(f), 6) AS f1_macro FROM (
          SELECT {columns}, k, 2.0::DOUBLE * count(*) FILTER (y = k AND p = k) / (count(*) FILTER (y = k) + count(*) FILTER (p = k)) AS f,
           any_value(acc) AS acc
          FROM (SELECT *, avg((y = p)::INT) OVER (PARTITION BY position) AS acc FROM tried), (VALUES ('OUI'), ('NON')) z(k)
          WHERE k IN (SELECT y FROM tried) OR k = p GROUP BY {columns}, k) WHERE f IS NOT NULL GROUP BY {columns}""",
    }


RULE_SQL = results_sql(
    ", ".join(f"({i}, '{n}', {t})" for i, n, t in RULES), "position, classifier, threshold",
    """CASE classifier WHEN 'length' THEN length(description) WHEN 'urgency' THEN urgence_num::INT ELSE length(demandeur) END >= threshold""",
)
NGRAM_SQL = results_sql(
    ", ".join(f"({i}, {a}, {b}, {m}, {c}::DOUBLE)" for i, a, b, m, c in NGRAMS), "position, low, high, max_features, c",
    "(length(description) * (low + 2 * high) % (max_features // 1000)) * c >= 1.0",
)


@query("w2_best_per_classifier", o.sql(
    "SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY classifier ORDER BY f1_macro DESC, position) = 1", "clean", **RULE_SQL))
def best_per_classifier(spark, sf):
    return tuning.best_per_classifier(rule_results(spark, sf))


@query("w4_classifier_ranking", o.sql(
    """SELECT *, CAST(row_number() OVER (ORDER BY f1_macro DESC, position) AS INT) AS rank FROM (
      SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY classifier ORDER BY f1_macro DESC, position) = 1)""", "clean", **RULE_SQL))
def classifier_ranking(spark, sf):
    return tuning.classifier_ranking(rule_results(spark, sf))


@query("w3_best_per_ngram", o.sql(
    "SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY low, high ORDER BY f1_macro DESC, position) = 1", "clean", **NGRAM_SQL))
def best_per_ngram(spark, sf):
    return tuning.best_per_ngram(ngram_results(spark, sf))


@query("t2_top_settings", o.sql("SELECT * FROM results ORDER BY f1_macro DESC, position LIMIT 10", "clean", **NGRAM_SQL))
def top_settings(spark, sf):
    return tuning.top_settings(ngram_results(spark, sf))


@query("t3_best_setting", o.sql("SELECT * FROM results ORDER BY f1_macro DESC, position LIMIT 1", "clean", **NGRAM_SQL))
def best_setting(spark, sf):
    return tuning.best_setting(ngram_results(spark, sf))
