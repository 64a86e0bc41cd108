import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.operators.features import TEXT_CONFIGS
from ticketloom.operators.models import train_calibrated_svcs
from ticketloom.operators.ranking import largest_remainders, stratified_split
from ticketloom.plans import training, tuning
from ticketloom.registry.cleaning import tickets_table
from ticketloom.registry.training import cascade_tickets


@pytest.fixture(scope="module")
def split(spark, sf):
    return training.split_tickets(tickets_table(spark, sf), "omv", min_samples=8)


@pytest.mark.parametrize("span,size", [((1, 2), 150), ((2, 2), 60)])
def test_a_setting_of_the_design_equals_a_fit_of_its_own(spark, split, span, size):
    from dataclasses import replace

    base = TEXT_CONFIGS["omv"]
    design = tuning.shared_design(split, "omv", base, [(1, 1), (1, 2), (2, 2)], 200)
    prepared, data = design.setting(span, size)
    config = replace(base, low=span[0], high=span[1], max_features=size)
    alone = training.prepare(split, "omv", tuning.CATEGORY_COLUMNS, config)
    assert data.size == alone.features.size
    for mine, other in ((prepared.train, alone.train), (prepared.test, alone.test)):
        a, b = ({r.incident_id: r for r in x.collect()} for x in (mine, other))
        assert a.keys() == b.keys()
        for key in a:
            assert a[key]["indices"] == b[key]["indices"]
            assert a[key]["values"] == pytest.approx(b[key]["values"])
    shared, = train_calibrated_svcs(data, [0.5])
    single, = train_calibrated_svcs(alone.training_set(), [0.5])
    assert shared.converged and shared.weights == pytest.approx(single.weights, abs=1e-4)


def test_ngram_rows(spark, sf):
    grid = {"ngram_range": [(1, 1), (1, 2)], "max_features": [50, 100], "C": [1.0, 0.1]}
    rows = tuning.ngram_search(tickets_table(spark, sf), "omv", 8, grid).orderBy("position").collect()
    want = [(*s, m, c) for s in grid["ngram_range"] for m in grid["max_features"] for c in grid["C"]]
    assert [(r.low, r.high, r.max_features, r.c) for r in rows] == want
    assert all(r.converged and 0 < r.accuracy <= 1 for r in rows)


def test_out_of_fold_labels_do_not_see_their_row(spark, sf):
    tickets = cascade_tickets(spark, sf)
    trained, labels = training.train_cascade_omv(tickets, out_of_fold=3)
    _, in_sample = training.train_cascade_omv(tickets)
    rows = {r.incident_id: r.omv_pred for r in labels.collect()}
    seen = {r.incident_id: r.omv_pred for r in in_sample.collect()}
    assert rows.keys() == seen.keys()
    truth = {r.incident_id: r.omv for r in tickets.filter("omv IS NOT NULL").collect()}
    held = {r.incident_id for r in trained.predictions.collect()}
    fitted = [k for k in rows if k not in held]
    # a model agrees more with the rows it was trained on
    assert np.mean([rows[k] == truth[k] for k in fitted]) < np.mean([seen[k] == truth[k] for k in fitted])
    assert {k: rows[k] for k in held} == {k: seen[k] for k in held}


def test_largest_remainders(spark):
    rows = [(i, c) for i, c in enumerate("a" * 11 + "b" * 7 + "c" * 4 + "d" * 2)]
    df = spark.createDataFrame(rows, "incident_id long, label string")
    quota = {r.label: r._quota for r in largest_remainders(df, "label", 0.2).collect()}
    assert quota == {"a": 2, "b": 2, "c": 1, "d": 0}  # 5 rows of 24: shares 2.29, 1.46, 0.83, 0.42
    split = stratified_split(df, "label", exact=True)
    assert split.count() == len(rows) and split.filter("is_test").count() == 5
    found = {r.label: r.n for r in split.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert found == {"a": 2, "b": 2, "c": 1}
