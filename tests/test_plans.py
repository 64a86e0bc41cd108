import pytest
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.plans import clean, scoring, training, tuning
from ticketloom.plans.training import Cascade, Classifier
from ticketloom.registry import training as registered
from ticketloom.registry.cleaning import agents, tickets_table
from ticketloom.session import scratch_path
from ticketloom.sources.requests import encode_request, encode_response
from ticketloom.streaming import scoring as stream


@pytest.fixture(scope="module")
def models(spark, sf):
    return registered.gate_models(spark, sf, 8)


@pytest.fixture(scope="module")
def scored(spark, sf, models):
    return registered.gate_scores(spark, sf, 8)


def test_gate(spark, sf, scored):
    rows = scored.collect()
    assert len(rows) == 200 and len({r.incident_id for r in rows}) == 200
    for r in rows:
        if r.omv.prediction == "NON":
            assert r.service is None and r.origine is None
        else:
            assert r.service.confidence == 100.0 and r.service.source in ("deterministe", "tous")
            assert (r.service.source == "tous") == (r.service.prediction == "TOUS")
            top = [(-x.probabilite, x.classe) for x in r.origine.top_n]
            assert len(top) <= 3 and top == sorted(top) and r.origine.prediction == top[0][1]
        assert sum(x.probabilite for x in r.omv.top_n) == pytest.approx(1, abs=2e-4)


def test_models_beat_chance(models):
    omv, origine = models
    assert origine.metrics["accuracy"] > 0.6
    assert 0 <= omv.metrics["auc_roc"] <= 1


def test_save_and_load(spark, sf, models):
    path = scratch_path(spark, "model")
    models[1].classifier.save(spark, path)
    loaded = Classifier.load(spark, path)
    tickets = tickets_table(spark, sf)
    want = {r.incident_id: r.probabilities for r in models[1].classifier.probabilities(tickets).collect()}
    got = {r.incident_id: r.probabilities for r in loaded.probabilities(tickets).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_stream_equals_batch(spark, sf, models):
    folder, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    raw = clean.resolve_fields(fixtures.incidents(spark, sf))
    bodies = encode_request(raw).unionByName(
        spark.createDataFrame([(-1, '{"demandeur": null}')], "incident_id long, body string")
    )
    bodies.repartition(3).write.json(folder)
    omv, origine = (m.classifier for m in models)
    requests = stream.read_requests(spark, folder, max_files=1)  # several batches
    stream.start_scoring(requests, agents(spark, sf), omv, origine, out, state).awaitTermination()
    got = spark.read.parquet(out).select("incident_id", "omv", "service", "origine")
    want = stream.score_requests(bodies, agents(spark, sf), omv, origine)
    assert got.exceptAll(want).count() == 0 and got.count() == 201
    assert got.filter("incident_id = -1").first()["omv"] == "ERREUR"


def test_write_back_and_response(spark, sf, scored):
    raw = fixtures.incidents(spark, sf)
    part = scored.filter(F.col("incident_id") < 100)
    out = scoring.write_back(raw, part).orderBy("incident_id").collect()
    before = {r.incident_id: r for r in raw.collect()}
    labels = {r.incident_id: r for r in scoring.labels_of(scored).collect()}
    for r in out:
        want = labels[r.incident_id] if r.incident_id < 100 else before[r.incident_id]
        assert (r.omv, r.service, r.origine) == (want.omv, want.service, want.origine)
    text = encode_response(scored.filter("omv.prediction = 'OUI'")).first()["response"]
    assert '"source"' in text


def test_cascade(spark, sf):
    tickets = clean.clean_for_cascade(fixtures.incidents(spark, sf))
    first, omv_pred = training.train_cascade_omv(tickets)
    origine, without = training.train_cascade_target(tickets, omv_pred, "origine", 5)
    gains = training.cascade_gain(spark, "origine", origine, without)
    assert gains.count() == 3
    models = Cascade(first.classifier, origine.classifier, origine.classifier)
    rows = scoring.score_cascade(tickets, models).collect()
    assert len(rows) == 200
    ruled = [r for r in rows if r.confiance == 100.0 and not r.service]
    assert ruled and all(r.omv == "NON" for r in ruled)
    assert all(len(r.origine) == 3 for r in rows if r.service)
    unruled = scoring.score_cascade(tickets, models, rules=False)
    assert unruled.filter(F.size("service") == 0).count() == 0


def test_grids(spark, sf):
    tickets = tickets_table(spark, sf)
    grids = {"logreg": {"C": [0.5, 1.0]}, "linearsvc": {"C": [0.5, 5.0]},
             "random_forest": {"num_trees": [3], "max_depth": [None, 2], "min_leaf": [1]}}
    results = tuning.grid_search(tickets, "origine", 8, grids)
    assert results.count() == 6
    ranked = tuning.classifier_ranking(results).orderBy("rank").collect()
    assert [r.rank for r in ranked] == [1, 2, 3] and ranked[0].f1_macro >= ranked[-1].f1_macro
    small = {"ngram_range": [(1, 1), (1, 2)], "max_features": [50, 400], "C": [0.5, 5.0]}
    found = tuning.ngram_search(tickets, "origine", 8, small)
    assert found.count() == 8 and tuning.best_per_ngram(found).count() == 2
    best = tuning.best_setting(found).first()
    assert best.f1_macro == found.agg(F.max("f1_macro")).first()[0]
