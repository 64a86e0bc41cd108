"""Training: class weights, logistic regression, calibrated SVC, random forest."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.constants import FOLDS, SEED
from ticketloom.operators import linear
from ticketloom.operators.features import FeatureModel, as_vectors
from ticketloom.operators.ranking import class_join, folds
from ticketloom.session import materialise

# The gradient that may be left, relative to the one at the start. It makes the four decimals of a
# probability stable; a test compares with a much smaller one.
TOLERANCE = 1e-5

# Labels live on the driver; more classes than this is a key column, not a target.
MAX_CLASSES = 100_000


@dataclass
class TrainingSet:
    """Written training rows (incident_id, cls, weight, fold, indices, values) and their classes."""

    rows: DataFrame
    classes: list[str]
    counts: np.ndarray  # rows per class
    size: int


def class_table(df: DataFrame, label: str) -> DataFrame:
    """(label, n, cls, weight): sorted class codes and balanced weights n / (k * n_c).

    Computed from the class counts alone, whose number is bounded.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).limit(MAX_CLASSES + 1)
    rows = counts.collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    total = sum(r["n"] for r in rows)
    table = [
        (r[label], r["n"], i, total / (len(rows) * r["n"])) for i, r in enumerate(rows)
    ]
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(
        table, f"`{label}` {kind}, n long, cls int, weight double"
    )


def training_set(features: DataFrame, label: str, size: int, k: int = FOLDS) -> TrainingSet:
    """Encode labels, add balanced weights and folds, and write the rows once."""
    table = class_table(features, label)
    coded = class_join(features, table.select(label, "cls", "weight"), label, "inner")
    if k > 1:
        coded = folds(coded, "cls", k)
    else:
        coded = coded.withColumn("fold", F.lit(0))
    rows = materialise(
        coded.select("incident_id", "cls", "weight", "fold", "indices", "values"), "training"
    )
    classes = table.orderBy("cls").collect()
    return TrainingSet(
        rows, [str(r[label]) for r in classes], np.array([r["n"] for r in classes]), size
    )


# ---------------------------------------------------------------------------
# Calibrated SVC
# ---------------------------------------------------------------------------

def balanced(counts: np.ndarray) -> np.ndarray:
    """Class weights n / (k * n_c)."""
    return counts.sum() / (len(counts) * np.maximum(counts, 1))


def fold_counts(data: TrainingSet, k: int) -> np.ndarray:
    """(fold, class) row counts."""
    out = np.zeros((k, len(data.classes)))
    for row in data.rows.groupBy("fold", "cls").agg(F.count("*").alias("n")).collect():
        out[row.fold, row.cls] = row.n
    return out


def svc_problems(counts: np.ndarray, fold: int, c: float) -> list[linear.Problem]:
    """One-against-rest problems of one fold. Two classes weigh both sides, more only the positive."""
    weight = balanced(counts)
    if len(counts) == 2:
        return [linear.Problem(linear.HINGE, 1, fold, (c * weight[1], c * weight[0]))]
    return [
        linear.Problem(linear.HINGE, i, fold, (c * w, c)) for i, w in enumerate(weight)
    ]


def train_calibrated_svcs(
    data: TrainingSet, costs: list[float], k: int = FOLDS, tol: float = TOLERANCE
) -> list[linear.LinearModel]:
    """One calibrated model per cost; all costs, folds and classes share every data pass."""
    per_fold = fold_counts(data, k)
    if (per_fold < 1).any():
        raise ValueError(f"calibration needs at least {k} rows of every class")
    problems = [
        p for c in costs for f in range(k) for p in svc_problems(data.counts - per_fold[f], f, c)
    ]
    held = np.array(
        [(per_fold[p.fold, p.cls], per_fold[p.fold].sum() - per_fold[p.fold, p.cls]) for p in problems]
    )
    rows = data.rows.persist()
    try:
        weights, report, table, settled = linear.fit_calibrated(rows, data.size, problems, held, tol)
    finally:
        rows.unpersist()
    each = len(problems) // len(costs)
    return [
        linear.LinearModel(
            linear.CALIBRATED, data.classes, weights[:, s], table[s], k,
            settled and all(r <= tol for r in report.remaining[s]), report.passes)
        for s in (slice(i * each, (i + 1) * each) for i in range(len(costs)))
    ]


# ---------------------------------------------------------------------------
# Logistic regression
# ---------------------------------------------------------------------------

def train_logistics(
    data: TrainingSet, settings: list[tuple[float, int]], k: int = 1, tol: float = TOLERANCE,
    penalised_intercept: list[bool] | None = None,
) -> list[linear.LinearModel]:
    """Balanced L2 logistic regressions, one per (C, held-out fold).

    Fold -1 trains on all rows. All settings share every data pass. The intercept is penalised
    only for the settings that `penalised_intercept` marks.
    """
    marks = penalised_intercept or [False] * len(settings)
    per_fold = fold_counts(data, k) if any(f >= 0 for _, f in settings) else None
    problems = []
    for (c, fold), mark in zip(settings, marks):
        counts = data.counts if fold < 0 else data.counts - per_fold[fold]
        cost = tuple(c * balanced(counts))
        if len(cost) == 2:
            problems.append(linear.Problem(linear.BINARY, 1, fold, (cost[1], cost[0]), mark))
        else:
            problems.append(linear.Problem(linear.SOFTMAX, -1, fold, cost, mark))
    rows = data.rows.persist()
    try:
        weights, report = linear.fit(rows, data.size, problems, tol)
    finally:
        rows.unpersist()
    return [
        linear.LinearModel(
            linear.LOGISTIC, data.classes, weights[:, c], converged=left <= tol, passes=report.passes)
        for c, left in zip(linear.spans(problems), report.remaining)
    ]


def train_logistic(data: TrainingSet, c: float, tol: float = TOLERANCE) -> linear.LinearModel:
    return train_logistics(data, [(c, -1)], tol=tol)[0]


def train_spark_logistic(data: TrainingSet, c: float, max_iter: int = 1000) -> linear.LinearModel:
    """The same optimum from Spark's own estimator; it needs more data passes on rare features."""
    vectors = as_vectors(data.rows, data.size)
    model = LogisticRegression(
        labelCol="cls", featuresCol="features", weightCol="weight",
        family="binomial" if len(data.classes) == 2 else "multinomial",
        regParam=1.0 / (c * float(data.counts.sum())),  # balanced weights add up to the rows
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-6,
    ).fit(vectors)
    table = model.coefficientMatrix.toArray()
    weights = np.vstack([table.T, model.interceptVector.toArray()[None, :]])
    return linear.LinearModel(linear.LOGISTIC, data.classes, weights)


# ---------------------------------------------------------------------------
# Random forest
# ---------------------------------------------------------------------------

# Spark's deepest tree; "no limit" means this.
DEEPEST = 30


def train_forest(
    vectors: DataFrame, num_trees: int, max_depth: int | None, min_leaf: int, seed: int = SEED
):
    """Balanced random forest. No depth limit means Spark's deepest, 30."""
    return RandomForestClassifier(
        labelCol="cls", featuresCol="features", weightCol="weight", numTrees=num_trees,
        maxDepth=DEEPEST if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=1024,
    ).fit(vectors)


# ---------------------------------------------------------------------------
# Coefficients
# ---------------------------------------------------------------------------

def text_coefficients(model: linear.LinearModel, features: FeatureModel) -> DataFrame:
    """(term, coefficient) of a binary model's text features."""
    spark = features.vocab.sparkSession
    table = spark.createDataFrame(pa.table({
        "idx": pa.array(np.arange(features.n_terms, dtype=np.int32)),
        "coefficient": pa.array(model.weights[: features.n_terms, 0])}))
    return features.vocab.join(F.broadcast(table), "idx").select("term", "coefficient")


def strongest_terms(coefficients: DataFrame, n: int = 12) -> DataFrame:
    """The n most positive and n most negative terms: (side, term, coefficient)."""
    top = coefficients.orderBy(F.desc("coefficient"), "term").limit(n)
    bottom = coefficients.orderBy("coefficient", "term").limit(n)
    return top.select(F.lit("OUI").alias("side"), "term", "coefficient").unionByName(
        bottom.select(F.lit("NON").alias("side"), "term", "coefficient")
    )
