import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ticketloom.functions import fields, text
from ticketloom.operators.features import TextConfig, term_counts


def values(spark, inputs, expression):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, s string")
    return [r[1] for r in sorted(rows.select("i", expression(F.col("s")).alias("x")).collect())]


@pytest.mark.parametrize(
    "expression, pairs",
    [
        (text.label, [(" a_x000D_b\n c ", "A B C"), ("", None), (" nan ", None), ("None", None), (None, None)]),
        (text.free_text, [(None, ""), (" é \t\n b", "é b"), ("nan", "nan")]),
        (text.edge_label, [("nan", None), ("none", "NONE"), ("a  b", "A  B"), ("", "")]),
        (fields.requester, [
            ("X, y z", "Y Z X"), ("A,B,C", "B,C A"), ("X,", " X"), (" ", "INCONNU"), (None, "INCONNU"), ("bob", "BOB"),
        ]),
        (fields.requester_at_serving, [("X, y", "Y X"), ("", "INCONNU"), (" bob ", "BOB")]),
        (fields.agent, [("Zoé M *", "ZOÉ M"), ("#", "")]),
        (fields.at_serving, [("", "INCONNU"), ("  ", ""), (None, "INCONNU"), (" a ", "A")]),
        (lambda c: fields.city(text.free_text(c)), [
            ("à Paris.", "PARIS"), ("Parisot", "NON_PRECISEE"), ("lyon puis Paris", "LYON"), ("éparis", "NON_PRECISEE"),
        ]),
        (fields.urgency_number, [("2 - haute", 2.0), ("12", 1.0), ("haute", -1.0), (None, -1.0)]),
        (lambda c: fields.urgency_category(fields.urgency_number(c)), [("2 - haute", "2"), ("haute", "INCONNU")]),
        (fields.is_ruled_out, [
            ("écran pf5", True), ("MOT  DE PASSE", True), ("mdp", True), ("PF55", False), ("mdps", False), (None, False),
        ]),
        (lambda c: fields.yes_no(text.label(c)), [("peut-être", None), (" oui ", "OUI")]),
    ],
)
def test_literal_rows(spark, expression, pairs):
    assert values(spark, [a for a, _ in pairs], expression) == [b for _, b in pairs]


def test_accents_agree_with_unicode_data(spark):
    pool = [c for c in range(0x20, 0x2FA20) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    draw = random.Random(7)
    inputs = ["".join(chr(draw.choice(pool)) for _ in range(30)) for _ in range(3000)] + ["한글 ﬁn ½ Ａ é ো"]
    for form, keep in (
        ("NFD", lambda c: unicodedata.category(c) != "Mn"), ("NFKD", lambda c: not unicodedata.combining(c)),
    ):
        want = ["".join(c for c in unicodedata.normalize(form, s) if keep(c)) for s in inputs]
        assert values(spark, inputs, lambda c: text.strip_accents(c, form)) == want


def test_tokens_and_ngrams(spark):
    rows = spark.createDataFrame(
        [(1, "Le mot de passe"), (2, ""), (3, "un"), (4, "a b cd"), (5, "Été été ete")],
        "incident_id int, description string",
    )
    config = TextConfig(1, 2, 1, 100, accents=True, stop_words=True)
    got = {(r.incident_id, r.term): r.tf for r in term_counts(rows, config).collect()}
    assert got == {
        (1, "mot"): 1, (1, "passe"): 1, (1, "mot passe"): 1, (4, "cd"): 1, (5, "ete"): 1,
    }  # été is a stop word, ete is not
    plain = TextConfig(2, 3, 1, 100, accents=False, stop_words=False)
    got = {(r.incident_id, r.term): r.tf for r in term_counts(rows, plain).collect()}
    assert got == {
        (1, "le mot"): 1, (1, "mot de"): 1, (1, "de passe"): 1, (1, "le mot de"): 1,
        (1, "mot de passe"): 1, (5, "ete ete"): 2, (5, "ete ete ete"): 1,
    }


def test_tokeniser_runs_once(spark):
    rows = spark.createDataFrame([(1, "a")], "incident_id int, description string")
    counts = term_counts(rows.select("incident_id", text.free_text(F.col("description")).alias("description")), TextConfig(1, 3))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_rows_of_features_need_no_text_of_unknown_ngrams(spark):
    """F24 to F26: every n-gram of a ticket was counted as text and sent to the lookup, known or not."""
    from ticketloom.operators.features import fit_features, transform

    texts = ["mot clef mot clef", "clef mot seul", "mot clef seul seul", None, "", "tout autre chose"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "incident_id long, description string")
    config = TextConfig(1, 2, 2, 10, stop_words=False)
    model = fit_features(rows, [], config)
    known = {r.term: (r.idx, r.idf) for r in model.vocab.collect()}
    assert set(known) == {"clef", "mot", "mot clef", "clef mot", "seul"}
    found = transform(rows, model)
    assert "term" not in found._jdf.queryExecution().optimizedPlan().toString()
    for r in found.collect():
        words = (texts[r.incident_id] or "").split()
        terms = words + [" ".join(p) for p in zip(words, words[1:])]
        raw = {known[t][0]: (math.log(terms.count(t)) + 1) * known[t][1] for t in terms if t in known}
        length = math.sqrt(sum(x * x for x in raw.values()))
        assert r.indices == sorted(raw)
        assert r["values"] == pytest.approx([raw[i] / length for i in sorted(raw)])
