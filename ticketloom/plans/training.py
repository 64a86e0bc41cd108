"""Training plans: from cleaned tickets to a saved classifier and its test predictions."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.constants import (
    CATEGORY_COLUMNS, FOLDS, MIN_SAMPLES, SEED, SVC_C, TARGET_COLUMNS, TEST_SIZE, YES,
)
from ticketloom.operators import evaluate
from ticketloom.operators.features import (
    TEXT_CONFIGS, FeatureModel, TextConfig, fit_features, transform,
)
from ticketloom.operators.filters import frequent_classes, trainable
from ticketloom.operators.identity import check_identity
from ticketloom.operators.linear import LinearModel, predict
from ticketloom.operators.models import (
    TrainingSet, train_calibrated_svcs, train_logistics, training_set,
)
from ticketloom.operators.ranking import stratified_split
from ticketloom.session import materialise, together


@dataclass
class Classifier:
    """Fitted features and model of one target."""

    label: str
    features: FeatureModel
    model: LinearModel

    def probabilities(self, tickets: DataFrame, *keep: str, out: str = "probabilities") -> DataFrame:
        """(incident_id, *keep, probabilities)."""
        return predict(transform(tickets, self.features, *keep), self.model, out)

    def save(self, spark: SparkSession, path: str) -> None:
        self.features.save(f"{path}/features")
        self.model.save(spark, f"{path}/model")
        spark.createDataFrame([(json.dumps({"label": self.label}),)], "value string").coalesce(
            1
        ).write.mode("overwrite").text(f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Classifier:
        meta = json.loads(spark.read.text(f"{path}/classifier").first()[0])
        return cls(
            meta["label"],
            FeatureModel.load(spark, f"{path}/features"),
            LinearModel.load(spark, f"{path}/model"),
        )


@dataclass
class Prepared:
    """Split, fitted and written features of one target."""

    label: str
    features: FeatureModel
    train: DataFrame = field(repr=False)  # incident_id, label, is_test, indices, values
    test: DataFrame = field(repr=False)

    def training_set(self, k: int = FOLDS) -> TrainingSet:
        return training_set(self.train, self.label, self.features.size, k)


def split_tickets(
    tickets: DataFrame, label: str, only_yes: bool = False, min_samples: int = MIN_SAMPLES,
    test_size: float = TEST_SIZE, seed: int = SEED,
) -> DataFrame:
    """Trainable tickets of frequent classes with `is_test`, written once."""
    rows = check_identity(trainable(tickets, label, only_yes))
    if min_samples:
        rows = frequent_classes(rows, label, min_samples)
    return materialise(stratified_split(rows, label, "incident_id", test_size, seed), "split")


def prepare(
    split: DataFrame, label: str, columns: list[str], config: TextConfig, fit_scope: str = "train",
    counts: DataFrame | None = None, dictionary: DataFrame | None = None,
) -> Prepared:
    """Fit features on the train rows (or, `fit_scope="all"`, on every row) and encode all rows.

    `counts` (with is_test) and `dictionary` may come from an earlier setting on the same split.
    """
    def scope(df: DataFrame) -> DataFrame:
        return df if fit_scope == "all" else df.filter(~F.col("is_test"))

    fitted_on = None if counts is None else scope(counts)
    model = fit_features(scope(split), columns, config, fitted_on, dictionary)
    rows = materialise(transform(split, model, label, "is_test", counts=counts), "features")
    return Prepared(label, model, rows.filter(~F.col("is_test")), rows.filter("is_test"))


def best_class(probabilities: Column, classes: list[str]) -> Column:
    """The likeliest class, the first of equals."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.element_at(
        names, F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    )


def test_predictions(prepared: Prepared, model: LinearModel) -> DataFrame:
    """(incident_id, y, p, score, probabilities) of the test rows; score is the last class's."""
    scored = predict(prepared.test.drop("is_test"), model)
    return scored.select(
        "incident_id",
        F.col(prepared.label).cast("string").alias("y"),
        best_class(F.col("probabilities"), model.classes).alias("p"),
        F.element_at("probabilities", -1).alias("score"),
        "probabilities",
    )


def test_metrics(predictions: DataFrame, classes: list[str]) -> dict[str, float]:
    """accuracy, f1_macro, f1_weighted, and auc_roc for two classes."""
    row = evaluate.summary(predictions).first()
    out = {m: row[m] for m in ("accuracy", "f1_macro", "f1_weighted")}
    if len(classes) == 2:
        binary = predictions.select((F.col("y") == classes[1]).cast("int").alias("y"), "score")
        out["auc_roc"] = evaluate.roc_auc(binary).first()["auc"]
    return out


@dataclass
class Trained:
    classifier: Classifier
    predictions: DataFrame = field(repr=False)
    metrics: dict[str, float] = field(default_factory=dict)
    data: TrainingSet | None = field(default=None, repr=False)


def _finish(prepared: Prepared, model: LinearModel, data: TrainingSet | None = None) -> Trained:
    predictions = materialise(test_predictions(prepared, model), "predictions")
    classifier = Classifier(prepared.label, prepared.features, model)
    return Trained(classifier, predictions, test_metrics(predictions, model.classes), data)


def train_gate(
    tickets: DataFrame, target: str, min_samples: int = MIN_SAMPLES, test_size: float = TEST_SIZE,
    config: TextConfig | None = None, cost: float | None = None,
) -> Trained:
    """The production models: `omv` on all tickets, `origine` on true interventions."""
    label = TARGET_COLUMNS[target]
    split = split_tickets(tickets, label, target == "origine", min_samples, test_size)
    prepared = prepare(split, label, CATEGORY_COLUMNS, config or TEXT_CONFIGS[target])
    data = prepared.training_set()
    return _finish(prepared, train_calibrated_svcs(data, [cost or SVC_C[target]])[0], data)


def cross_validated_auc(
    prepared: Prepared, c: float, k: int = FOLDS
) -> tuple[LinearModel, DataFrame]:
    """(model on all train rows, one-row auc_mean and auc_std over folds).

    The full fit and all folds are one set of problems, so they share each data pass.
    """
    data = prepared.training_set(k)
    settings = [(c, -1)] + [(c, f) for f in range(k)]
    full, *per_fold = train_logistics(data, settings, k)
    parts = [
        predict(
            data.rows.filter(F.col("fold") == f).select("incident_id", "cls", "fold", "indices", "values"),
            model,
        )
        for f, model in enumerate(per_fold)
    ]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    held = scored.select(
        "fold", F.col("cls").alias("y"), F.element_at("probabilities", -1).alias("score")
    )
    aucs = evaluate.roc_auc(held, "fold")
    return full, aucs.agg(
        F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std")
    )


def train_binary(tickets: DataFrame, c: float = 1.0) -> tuple[Trained, DataFrame]:
    """The binary model on text, service and origin; features are fitted on all rows."""
    named = check_identity(tickets).withColumn("label", F.when(F.col("target") == 1, YES).otherwise("NON"))
    split = materialise(stratified_split(named, "label"), "split")
    prepared = prepare(split, "label", ["service", "origine"], TEXT_CONFIGS["binary"], "all")
    model, aucs = cross_validated_auc(prepared, c)
    return _finish(prepared, model), aucs


def train_multi(
    tickets: DataFrame, target: str, c: float = 5.0, min_samples: int = MIN_SAMPLES
) -> Trained:
    """A text-only multi-class model; features are fitted on all rows."""
    label = TARGET_COLUMNS[target]
    split = split_tickets(tickets, label, min_samples=min_samples)
    prepared = prepare(split, label, [], TEXT_CONFIGS["multi"], "all")
    return _finish(prepared, train_logistics(prepared.training_set(1), [(c, -1)])[0])


@dataclass
class Cascade:
    omv: Classifier
    service: Classifier
    origine: Classifier

    def save(self, spark: SparkSession, path: str) -> None:
        for name in ("omv", "service", "origine"):
            getattr(self, name).save(spark, f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Cascade:
        return cls(*[Classifier.load(spark, f"{path}/{n}") for n in ("omv", "service", "origine")])


def train_cascade_omv(
    tickets: DataFrame, min_samples: int = 0, out_of_fold: int = 0, c: float = 1.0
) -> tuple[Trained, DataFrame]:
    """(model, omv_pred): the first stage and its label for every trainable row.

    Predictions on training rows are in-sample; with `out_of_fold` folds each training row is
    labelled by a model that was trained without its fold, so that the second stage sees labels as
    good as those of new tickets. All folds and the full fit are one set of problems.
    """
    split = split_tickets(tickets, "omv", min_samples=min_samples)
    prepared = prepare(split, "omv", ["cause", "traite"], TEXT_CONFIGS["cascade_omv"], "all")
    data = prepared.training_set(max(1, out_of_fold))
    settings = [(c, -1), *((c, f) for f in range(out_of_fold))]
    model, *without = train_logistics(data, settings, max(1, out_of_fold))

    def labels(rows: DataFrame, by: LinearModel) -> DataFrame:
        return predict(rows.select("incident_id", "indices", "values"), by).select(
            "incident_id", best_class(F.col("probabilities"), by.classes).alias("omv_pred"))

    seen = [labels(data.rows.filter(F.col("fold") == f), m) for f, m in enumerate(without)]
    every = reduce(DataFrame.unionByName, [labels(prepared.test, model), *(seen or [labels(prepared.train, model)])])
    return _finish(prepared, model), materialise(every, "omv_pred")


def align_omv(tickets: DataFrame, omv_pred: DataFrame) -> DataFrame:
    """Attach the predicted label by ticket; tickets without one stay null."""
    return tickets.join(omv_pred, "incident_id", "left")


def train_cascade_target(
    tickets: DataFrame, omv_pred: DataFrame, target: str, min_samples: int = MIN_SAMPLES,
    c: float = 5.0, stages: tuple[list[str], ...] = (["omv_pred"], []),
) -> tuple[Trained, ...]:
    """(with, without) the predicted intervention as a feature, on the same split."""
    label = TARGET_COLUMNS[target]
    split = split_tickets(align_omv(tickets, omv_pred), label, min_samples=min_samples)

    def train(extra: list[str]) -> Trained:
        prepared = prepare(split, label, ["cause", "traite", *extra], TEXT_CONFIGS["multi"], "all")
        return _finish(prepared, train_logistics(prepared.training_set(1), [(c, -1)])[0])

    return tuple(together(*[lambda extra=extra: train(extra) for extra in stages]))


def cascade_gain(spark: SparkSession, target: str, with_: Trained, without: Trained) -> DataFrame:
    """(target, metric, without_cascade, with_cascade, gain)."""
    rows = [
        (target, m, float(without.metrics[m]), float(with_.metrics[m]),
         float(with_.metrics[m] - without.metrics[m]))
        for m in ("accuracy", "f1_macro", "f1_weighted")
    ]
    return spark.createDataFrame(
        rows, "target string, metric string, without_cascade double, with_cascade double, gain double"
    )


def stacking_gains(spark: SparkSession, target: str, without: Trained, in_sample: Trained, crossed: Trained) -> DataFrame:
    """(target, metric, without_cascade, in_sample, out_of_fold, and the gains of the last two)."""
    rows = [
        (target, m, *(float(t.metrics[m]) for t in (without, in_sample, crossed)),
         *(float(t.metrics[m] - without.metrics[m]) for t in (in_sample, crossed)))
        for m in ("accuracy", "f1_macro", "f1_weighted")
    ]
    return spark.createDataFrame(
        rows, "target string, metric string, without_cascade double, in_sample double, out_of_fold double, "
        "in_sample_gain double, out_of_fold_gain double")
