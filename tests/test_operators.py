import math
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticketloom.operators import evaluate, filters, joins, ranking
from ticketloom.operators import features as ft


def test_rank_equals_window_under_skew(spark):
    # One class holds most rows.
    df = spark.range(20000).select(
        F.col("id").alias("incident_id"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("k")
    )
    order = ranking.hash_order("incident_id", 42)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(order, "incident_id")).cast("long"))
    got = ranking.rank_in_group(df, ["k"], order, "incident_id")
    assert got.exceptAll(want).count() == 0 and got.count() == 20000


def test_split_has_every_class_on_both_sides(spark):
    df = spark.range(500).select(F.col("id").alias("incident_id"), F.when(F.col("id") < 10, "rare").otherwise("common").alias("k"))
    got = {(r.k, r.is_test): r["count"] for r in ranking.stratified_split(df, "k").groupBy("k", "is_test").count().collect()}
    assert got == {("rare", True): 2, ("rare", False): 8, ("common", True): 98, ("common", False): 392}


def test_split_ignores_classes_when_one_is_single(spark):
    df = spark.range(101).select(F.col("id").alias("incident_id"), F.when(F.col("id") == 0, "one").otherwise("many").alias("k"))
    got = ranking.stratified_split(df, "k")
    assert got.filter("is_test").count() == math.ceil(0.2 * 101) and got.count() == 101


def test_salted_and_broadcast_lookup_agree(spark):
    tickets = spark.createDataFrame(
        [(i, n) for i, n in enumerate(["INCONNU", "ZOÉ M", "ZOE N", "ZOÉ N", "X", "ZOÉ M"] * 50)], "incident_id long, demandeur string"
    )
    agents = spark.createDataFrame([("ZOÉ M", "A"), ("ZOE M", "B"), ("ZOE N", "C"), ("INCONNU", "never")], "agent string, service string")
    small = joins.lookup_service(tickets, agents, small=True)
    large = joins.lookup_service(tickets, agents, small=False).select(small.columns)
    assert small.exceptAll(large).count() == 0 and large.count() == 300
    got = {r.demandeur: r.service_deterministe for r in small.collect()}
    assert got == {"INCONNU": None, "ZOÉ M": "A", "ZOE N": "C", "ZOÉ N": "C", "X": None}


def test_frequent_and_rare(spark):
    df = spark.createDataFrame([(i, "a" if i < 5 else "b" if i < 7 else None) for i in range(9)], "incident_id long, k string")
    assert filters.frequent_classes(df, "k", 3).count() == 5
    assert [tuple(r) for r in filters.rare_classes(df, "k", 3).collect()] == [("b", 2)]
    assert tuple(filters.class_filter_report(df, "k", 3).first()) == (5, 1, 4)


def test_scores_of_odd_labels(spark):
    # b is never predicted, c is predicted but never true.
    df = spark.createDataFrame([("a", "a"), ("b", "c"), ("a", "a"), ("b", "a")], "y string, p string")
    report = {r["class"]: r for r in evaluate.class_report(evaluate.confusion(df)).collect()}
    assert report["b"].f1 == 0 and report["c"].f1 == 0 and report["c"].support == 0
    row = evaluate.summary(df).first()
    f1_a = 2 * 2 / (2 + 3)
    assert row.f1_macro == pytest.approx(f1_a / 3) and row.f1_weighted == pytest.approx(f1_a / 2)


def test_auc_counts_pairs(spark):
    draw = random.Random(3)
    rows = [(draw.choice("uv"), draw.randint(0, 1), round(draw.random(), 1) if i % 3 else 0.5) for i in range(400)]
    got = {r.g: r.auc for r in evaluate.roc_auc(spark.createDataFrame(rows, "g string, y int, score double"), "g").collect()}
    for g in "uv":
        pos = [s for k, y, s in rows if k == g and y]
        neg = [s for k, y, s in rows if k == g and not y]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[g] == pytest.approx(wins / len(pos) / len(neg))


def test_features_against_brute_force(spark):
    texts = ["le chat dort", "le chien dort dort", "", "un chat un chien", "x"]
    cats = ["a", "b", None, "a", "b"]
    df = spark.createDataFrame(list(zip(range(5), texts, cats)), "incident_id long, description string, cause string")
    config = ft.TextConfig(1, 2, 1, 6, accents=True, stop_words=False)

    def grams(s):
        w = [t for t in s.split() if len(t) > 1]
        return Counter(w + [" ".join(p) for p in zip(w, w[1:])])

    docs = [grams(s) for s in texts]
    total, df_ = Counter(), Counter()
    for d in docs:
        total.update(d)
        df_.update(d.keys())
    vocab = sorted(sorted(total, key=lambda t: (-total[t], t))[:6])
    model = ft.fit_features(df, ["cause"], config)
    assert [r.term for r in model.vocab.orderBy("idx").collect()] == vocab
    rows = {r.incident_id: r for r in ft.transform(df, model).collect()}
    assert len(rows) == 5
    for i, d in enumerate(docs):
        raw = {vocab.index(t): (1 + math.log(n)) * (math.log(6 / (1 + df_[t])) + 1) for t, n in d.items() if t in vocab}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        text = [(k, v) for k, v in zip(rows[i].indices, rows[i]["values"]) if k < model.n_terms]
        assert [k for k, _ in text] == sorted(raw)
        assert [v for _, v in text] == pytest.approx([raw[k] / norm for k in sorted(raw)])
        assert sum(k >= model.n_terms for k in rows[i].indices) == 1  # the category, null as unknown
    unseen = df.withColumn("cause", F.lit("new")).withColumn("description", F.lit("zzz"))
    assert all(r.indices == [] for r in ft.transform(unseen, model).collect())
