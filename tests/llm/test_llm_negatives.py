import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.llm import hard_negatives as H

SCHEMA = "id long, label int, vector array<long>"


def plain(rows, every=3, k=5, m=5, low=80, high=100):
    rows = [r for r in rows if None not in r and None not in r[2]]
    out = Counter()
    for at, (ident, label, vector) in enumerate(rows):
        if ident % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, lab, n) for n, (i, lab, v) in enumerate(rows)]
        same = sorted((s, i) for s, i, lab, n in scored if lab == label and n != at)[:k]
        for s, positive in same:
            fit = sorted((t, i) for t, i, lab, _ in scored if lab != label and low * -s <= 100 * -t <= high * -s)[:m]
            out.update((ident, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(fit, 1))
    return out


def mined(spark, rows, every=3, parts=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("anchor_id", F.lit("x")).withColumn("score", F.lit(1))
    return Counter(map(tuple, H.hard_negatives(df, F.col("id") % every == 0, **options).collect()))


def _vectors(seed, n, width=4, spread=6, labels=3):
    draw = random.Random(seed)
    return [(i, draw.randrange(labels), [draw.randint(-1, spread) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain(spark, seed):
    rows = _vectors(seed, 120)
    assert mined(spark, rows) == plain(rows)


def test_other_limits(spark):
    rows = _vectors(3, 80)
    assert mined(spark, rows, low=50, high=150, positives=3, negatives=2) == plain(rows, 3, 3, 2, 50, 150)


def test_odd_rows(spark):
    rows = _vectors(4, 60, spread=2)  # many ties
    rows += [rows[3]] * 4 + rows[6:9]  # repeated rows, anchors among them
    rows += [(None, 1, [1, 2, 3, 4]), (300, None, [1, 2, 3, 4]), (303, 1, None), (306, 1, [1, None, 3, 4]),
             (309, 1, []), (312, 1, [5]), (315, 2, [1, 2, 3, 4, 5, 6]), (-3, 2, [-4, -4, -4, -4])]
    assert mined(spark, rows) == plain(rows)


def test_pieces_and_steps(spark, monkeypatch):
    monkeypatch.setattr(H, "PIECE_VALUES", 40)
    monkeypatch.setattr(H, "STEP", 7)
    rows = _vectors(5, 90)
    assert mined(spark, rows, every=2, parts=3) == plain(rows, 2)


def test_one_label_or_nothing(spark):
    assert mined(spark, [(i, 1, [i, 1]) for i in range(10)]) == Counter()
    assert mined(spark, [(1, 1, [2])]) == mined(spark, []) == Counter()


def test_large_scores():
    left, right = np.array([[1 << 31, 3]]), np.array([[1 << 31, 5], [-(1 << 31), 1]])
    assert H.products(left, right).tolist() == [[(1 << 62) + 15, -(1 << 62) + 3]]
    with pytest.raises(OverflowError):
        H.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_quantised(spark):
    rows = [([0.5, -0.001],), ([None, 1.0],), ([float("nan")],), ([float("inf")],), (None,), ([],)]
    df = spark.createDataFrame(rows, "v array<float>").select(H.quantised("v"))
    assert [r[0] for r in df.collect()] == [[128, -1], None, None, None, None, []]
