"""Registered queries that train: models, cascade, tuning, scoring, streaming, save and load.

Trained models are iterative and have no SQL; tests check them against direct
solutions on small data.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.constants import CATEGORY_COLUMNS, FOLDS, MIN_SAMPLES, TARGET_COLUMNS
from ticketloom.operators import filters
from ticketloom.operators.features import TEXT_CONFIGS, as_vectors
from ticketloom.operators.models import strongest_terms, text_coefficients, train_forest
from ticketloom.plans import bundle, clean, scoring, training, tuning
from ticketloom.plans.training import Cascade, Classifier, best_class
from ticketloom.registry import oracle as o
from ticketloom.registry.catalog import kept, query
from ticketloom.registry.cleaning import agents, tickets_table
from ticketloom.session import materialise, scratch_path, together
from ticketloom.sources.requests import encode_request
from ticketloom.streaming import scoring as stream

def cascade_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf, "cascade tickets", lambda: materialise(
        clean.clean_for_cascade(fixtures.incidents(spark, sf)), "tickets"
    ))


def gate_models(
    spark: SparkSession, sf: str, min_samples: int = MIN_SAMPLES
) -> tuple[training.Trained, training.Trained]:
    """The production models for intervention and origin."""
    tickets = tickets_table(spark, sf)
    return tuple(together(*[
        lambda t=target: kept(
            spark, sf, f"gate {t} {min_samples}", lambda: training.train_gate(tickets, t, min_samples))
        for target in ("omv", "origine")
    ]))


def cascade_models(spark: SparkSession, sf: str) -> tuple[Cascade, DataFrame, dict[str, tuple]]:
    """(models, gains of the cascade over models without it, (with, without) by target)."""

    def make():
        tickets = cascade_tickets(spark, sf)
        first, omv_pred = training.train_cascade_omv(tickets)
        found, gains, targets = [first.classifier], None, ("service", "origine")
        trained = dict(zip(targets, together(*[
            lambda t=target: training.train_cascade_target(tickets, omv_pred, t) for target in targets])))
        for target, (with_, without) in trained.items():
            found.append(with_.classifier)
            gain = training.cascade_gain(spark, target, with_, without)
            gains = gain if gains is None else gains.unionByName(gain)
        return Cascade(*found), gains, trained

    return kept(spark, sf, "cascade", make)


def binary_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf, "binary tickets", lambda: materialise(
        clean.clean_for_binary(fixtures.incidents(spark, sf)), "tickets"
    ))


def binary_model(spark: SparkSession, sf: str) -> tuple[training.Trained, DataFrame]:
    tickets = binary_tickets(spark, sf)
    return kept(spark, sf, "binary", lambda: training.train_binary(tickets))


def multi_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf, "multi tickets", lambda: materialise(
        clean.clean_for_multi(fixtures.incidents(spark, sf)), "tickets"
    ))


def multi_models(spark: SparkSession, sf: str) -> tuple[training.Trained, training.Trained]:
    tickets = multi_tickets(spark, sf)
    return kept(spark, sf, "multi", lambda: tuple(together(*[
        lambda t=target: training.train_multi(tickets, t) for target in ("service", "origine")
    ])))


def flat_predictions(trained: training.Trained) -> DataFrame:
    return trained.predictions.select("incident_id", "y", "p", F.round("score", 6).alias("score"))


@query("m1_logistic_multi")
def logistic_multi(spark, sf):
    service, origine = multi_models(spark, sf)
    return flat_predictions(service).withColumn("target", F.lit("service")).unionByName(
        flat_predictions(origine).withColumn("target", F.lit("origine"))
    )


@query("m1_logistic_binary")
def logistic_binary(spark, sf):
    return flat_predictions(binary_model(spark, sf)[0])


@query("e4_cross_validated_auc")
def cross_validated_auc(spark, sf):
    return binary_model(spark, sf)[1]


@query("t4_strongest_terms")
def strongest(spark, sf):
    classifier = binary_model(spark, sf)[0].classifier
    return strongest_terms(text_coefficients(classifier.model, classifier.features))


@query("m2_calibrated_svc")
def calibrated_svc(spark, sf):
    omv, origine = gate_models(spark, sf)
    return flat_predictions(omv).withColumn("target", F.lit("omv")).unionByName(
        flat_predictions(origine).withColumn("target", F.lit("origine"))
    )


def forest_predictions(spark: SparkSession, sf: str, target: str) -> DataFrame:
    label = TARGET_COLUMNS[target]
    split = training.split_tickets(tickets_table(spark, sf), label, target == "origine")
    prepared = training.prepare(split, label, CATEGORY_COLUMNS, TEXT_CONFIGS[target])
    data = prepared.training_set(1)
    model = train_forest(as_vectors(data.rows, data.size), 100, 10, 1)
    scored = model.transform(as_vectors(prepared.test, data.size))
    return scored.select(
        F.lit(target).alias("target"), "incident_id", F.col(label).alias("y"),
        best_class(vector_to_array("probability"), data.classes).alias("p"),
    )


@query("m3_random_forest")
def random_forest(spark, sf):
    tickets_table(spark, sf)
    omv, origine = together(*[lambda t=target: forest_predictions(spark, sf, t) for target in ("omv", "origine")])
    return omv.unionByName(origine)


@query("m4_cascade_gain")
def cascade_gain(spark, sf):
    return cascade_models(spark, sf)[1]


@query("m4_out_of_fold")
def out_of_fold_gain(spark, sf):
    """The cascade's gains with in-sample and with cross-fitted labels of the training rows."""
    trained = cascade_models(spark, sf)[2]
    tickets = cascade_tickets(spark, sf)
    _, omv_pred = kept(spark, sf, "crossed", lambda: training.train_cascade_omv(tickets, out_of_fold=FOLDS))
    crossed = together(*[
        lambda t=target: training.train_cascade_target(tickets, omv_pred, t, stages=(["omv_pred"],))
        for target in trained])
    parts = [
        training.stacking_gains(spark, target, without, in_sample, own)
        for (target, (in_sample, without)), (own,) in zip(trained.items(), crossed)
    ]
    return parts[0].unionByName(parts[1])


def both_targets(search, spark: SparkSession, sf: str) -> DataFrame:
    tickets = tickets_table(spark, sf)
    omv, origine = together(*[
        lambda t=target: search(tickets, t).withColumn("target", F.lit(t)) for target in ("omv", "origine")])
    return omv.unionByName(origine)


def searched(name: str, search, spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf, name, lambda: materialise(both_targets(search, spark, sf), name.replace(" ", "-")))


def by_target(results: DataFrame, rank) -> DataFrame:
    """A ranking of each target's own results."""
    parts = [rank(results.filter(F.col("target") == t).drop("target")).withColumn("target", F.lit(t)) for t in ("omv", "origine")]
    return parts[0].unionByName(parts[1])


@query("e8_grid_search")
def grid_search(spark, sf):
    """The whole grid of the three classifiers on both targets."""
    return searched("grid search", tuning.grid_search, spark, sf)


@query("e8_classifier_ranking")
def grid_ranking(spark, sf):
    """The classifiers of the searched grid by their best setting."""
    return by_target(searched("grid search", tuning.grid_search, spark, sf), tuning.classifier_ranking)


@query("e9_ngram_search")
def ngram_search(spark, sf):
    """The whole n-gram, vocabulary and cost grid on both targets."""
    return searched("ngram search", tuning.ngram_search, spark, sf)


@query("e9_best_per_ngram")
def ngram_ranking(spark, sf):
    """The best setting of each n-gram range that was searched."""
    return by_target(searched("ngram search", tuning.ngram_search, spark, sf), tuning.best_per_ngram)


@query("e9_top_settings")
def ngram_top(spark, sf):
    """The ten best settings of the n-gram search."""
    return by_target(searched("ngram search", tuning.ngram_search, spark, sf), tuning.top_settings)


def flat_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "incident_id", F.col("omv.prediction").alias("omv"), F.col("omv.confidence").alias("confidence"),
        F.col("service.prediction").alias("service"), F.col("service.source").alias("service_source"),
        F.col("origine.prediction").alias("origine"),
        F.col("origine.confidence").alias("origine_confidence"),
        F.size("origine.top_n").alias("origine_ranked"),
    )


def gate_scores(spark: SparkSession, sf: str, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Every ticket through gate, lookup and origin model."""
    omv, origine = gate_models(spark, sf, min_samples)
    return scoring.score_gate(tickets_table(spark, sf), omv.classifier, origine.classifier)


@query("x1_score_tickets")
def score_tickets(spark, sf):
    return flat_scores(gate_scores(spark, sf))


@query("x2_score_cascade")
def score_cascade(spark, sf):
    scored = scoring.score_cascade(cascade_tickets(spark, sf), cascade_models(spark, sf)[0])
    return scored.select(
        "incident_id", "omv", "confiance", F.get("service", F.lit(0))["classe"].alias("service"),
        F.get("origine", F.lit(0))["classe"].alias("origine"),
    )


@query("x3_score_binary")
def score_binary(spark, sf):
    return scoring.score_binary(binary_tickets(spark, sf), binary_model(spark, sf)[0].classifier)


@query("x4_score_multi")
def score_multi(spark, sf):
    service, origine = multi_models(spark, sf)
    scored = scoring.score_multi(multi_tickets(spark, sf), service.classifier, origine.classifier)
    return scored.select(
        "incident_id", F.get("service", F.lit(0))["classe"].alias("service"),
        F.get("origine", F.lit(0))["classe"].alias("origine"),
    )


@query("x5_case_report")
def case_report(spark, sf):
    """Labelled tickets as cases: what the models say against what was filed."""
    tickets = tickets_table(spark, sf)
    cases = filters.trainable(tickets, "omv").select(
        "incident_id", F.concat(F.lit("ticket "), "incident_id").alias("label"),
        F.col("omv").alias("expected_omv"),
        F.coalesce("service_deterministe", F.lit("TOUS")).alias("expected_service"),
        F.col("origine_clean").alias("expected_origine"),
    )
    return scoring.case_report(cases, gate_scores(spark, sf))


@query("x7_stream_scoring")
def stream_scoring(spark, sf):
    """All tickets as a stream of JSON requests, scored batch by batch."""
    omv, origine = gate_models(spark, sf)
    folder, out, state = (scratch_path(spark, n) for n in ("requests", "scored", "state"))
    requests = encode_request(clean.resolve_fields(fixtures.incidents(spark, sf)))
    requests.write.json(folder)
    team = materialise(agents(spark, sf), "agents")
    running = stream.start_scoring(
        stream.read_requests(spark, folder), team, omv.classifier, origine.classifier, out, state
    )
    running.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("s15_saved_model")
def saved_model(spark, sf):
    """Scores of the model as written and read back."""
    path = scratch_path(spark, "model")
    gate_models(spark, sf)[0].classifier.save(spark, path)
    loaded = Classifier.load(spark, path)
    return loaded.probabilities(tickets_table(spark, sf)).select(
        "incident_id", F.round(F.element_at("probabilities", -1), 6).alias("probability")
    )


@query("s15_bundle", o.sql("SELECT agent, service FROM agents", "agents"))
def bundle_agents(spark, sf):
    """The agent map of a release that was saved, published and loaded with its models."""
    omv, origine = gate_models(spark, sf)
    path = scratch_path(spark, "releases")
    version = bundle.save_bundle(
        spark, path, agents(spark, sf), omv.classifier, origine.classifier, {"min_samples": MIN_SAMPLES})
    return bundle.load_bundle(spark, path, version).agents
