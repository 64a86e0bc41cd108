import pytest
from pyspark.sql import functions as F

from ticketloom.constants import CATEGORY_COLUMNS, INCIDENT_NUMBER
from ticketloom.operators import evaluate
from ticketloom.operators.features import TextConfig, fit_features, transform
from ticketloom.operators.identity import check_identity, with_identity
from ticketloom.operators.ranking import hash_order, rank_in_group, stratified_split
from ticketloom.plans import clean, scoring, training
from ticketloom.registry.cleaning import agents

LAYOUT = "`{}` string, Description string, `INTERVENTION OMV` string, SERVICE string, ORIGINE string, `Cause réelle` string, `Traité par` string"


def tickets_of(spark, numbers):
    """A hundred tickets as files document them: with these numbers, or without the column."""
    rows = [
        (n, f"panne {'base' if i % 2 else 'saisie'} numero{i} poste{i % 7}", "OUI" if i % 3 else "NON", "NANCY",
         "PROGRAMME" if i % 2 else "TELEPHONE", f"C{i % 4}", f"T{i % 3}")
        for i, n in enumerate(numbers)
    ]
    df = spark.createDataFrame(rows, LAYOUT.format(INCIDENT_NUMBER)).repartition(4)
    return df if numbers[0] != "absent" else df.drop(INCIDENT_NUMBER)


@pytest.mark.parametrize("numbers", [["absent"] * 100, [""] * 100, [None] * 100, [f"I{i // 10}" for i in range(100)]])
def test_every_ticket_is_kept_once(spark, sf, numbers):
    tickets = clean.clean_tickets(tickets_of(spark, numbers), agents(spark, sf))
    assert tickets.count() == 100
    check_identity(tickets)
    assert ("ticket_number" in tickets.columns) == (numbers[0] != "absent")
    split = training.split_tickets(tickets, "omv", min_samples=5)
    assert split.count() == 100 and split.where("is_test").count() == 21  # ceil per class
    config = TextConfig(1, 1, 1, 1000, stop_words=False)
    rows = transform(tickets, fit_features(tickets, CATEGORY_COLUMNS, config)).collect()
    assert len(rows) == len({r.incident_id for r in rows}) == 100
    # four words and five categories a ticket, none merged with another ticket's
    assert all(len(r.indices) == 9 and sorted(set(r.indices)) == r.indices for r in rows)


def test_training_and_scoring_without_numbers(spark, sf):
    tickets = clean.clean_tickets(tickets_of(spark, ["absent"] * 100), agents(spark, sf))
    gate = training.train_gate(tickets, "omv", min_samples=5)
    origine = training.train_gate(tickets, "origine", min_samples=5)
    assert gate.classifier.model.converged and origine.classifier.model.converged
    scored = scoring.score_gate(tickets, gate.classifier, origine.classifier)
    assert scored.count() == scored.select("incident_id").distinct().count() == 100


def test_bad_identities_are_refused(spark):
    for ids in ([1, 1, 2], [1, None]):
        df = spark.createDataFrame([(i, "x") for i in ids], "incident_id long, description string")
        assert with_identity(df) is df
        with pytest.raises(ValueError, match="unique"):
            check_identity(df)


@pytest.mark.parametrize("classes", [3, 1, 100])
def test_split_is_that_of_the_ranks(spark, classes):
    df = spark.range(100).selectExpr("id as incident_id", f"id % {classes} as label")
    got = {r.incident_id for r in stratified_split(df, "label").where("is_test").collect()}
    group = ["label"] if classes < 100 else []
    ranked = rank_in_group(df, group, hash_order("incident_id", 42), "incident_id")
    n = 100 if classes == 100 else None
    sizes = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    want = {r.incident_id for r in ranked.collect() if r.rn <= -(-(n or sizes[r.label]) // 5)}
    assert got == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_and_vectors_move_no_texts(spark, sf):
    tickets = clean.clean_tickets(tickets_of(spark, [""] * 100), agents(spark, sf))
    tickets.write.mode("overwrite").parquet(path := __import__("ticketloom.session", fromlist=["x"]).scratch_path(spark, "t"))
    tickets = spark.read.parquet(path)
    exchanges = [x for x in plan_of(stratified_split(tickets, "omv")).split("\n") if "Exchange" in x]
    assert not any("description" in x for x in exchanges if "Broadcast" not in x)
    rows = transform(tickets, fit_features(tickets, CATEGORY_COLUMNS, TextConfig()), "description")
    plan = plan_of(rows)
    assert "Exchange" not in plan and plan.count("regexp_extract_all") == 1


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.2)], "y int, score double")
    assert evaluate.roc_auc(df).first()["auc"] is None
