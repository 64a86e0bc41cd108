import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.operators import linear, models


@pytest.fixture(scope="module")
def data(spark):
    """Sparse rows of three classes that overlap, in five folds."""
    draw = np.random.default_rng(5)
    rows, dense, cls = [], np.zeros((240, 30)), draw.integers(0, 3, 240)
    for i in range(240):
        idx = np.sort(draw.choice(30, 6, replace=False))
        val = draw.normal(size=6) + (idx % 3 == cls[i]) * 1.0
        dense[i, idx] = val
        rows.append((i, int(cls[i]), 1.0, i % 5, idx.tolist(), val.tolist()))
    df = spark.createDataFrame(
        rows, "incident_id long, cls int, weight double, fold int, indices array<int>, values array<double>"
    ).repartition(4).persist()
    counts = np.bincount(cls, minlength=3)
    weight = models.balanced(counts)
    df = df.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weight]), F.col("cls") + 1))
    return models.TrainingSet(df, ["a", "b", "c"], counts, 30), dense, cls


def objective(problem, w, dense, cls):
    x = np.hstack([dense, np.ones((len(dense), 1))])
    loss, factors = linear.loss_and_factors(problem, x @ w, cls, np.arange(len(cls)) % 5)
    ridge = np.append(np.ones(30), 1.0 if problem.loss == "hinge" else 0.0)[:, None]
    return loss + 0.5 * (ridge * w * w).sum(), x.T @ factors + ridge * w


@pytest.fixture(params=["rows in every task", "rows dealt to tasks"])
def way(request, monkeypatch):
    if request.param == "rows dealt to tasks":
        monkeypatch.setattr(linear, "LOCAL_NUMBERS", -1)


@pytest.mark.parametrize("problem", [
    linear.Problem("hinge", 1, 2, (2.0, 0.5)), linear.Problem("binary", 0, -1, (2.0, 0.5)),
    linear.Problem("softmax", -1, 3, (1.0, 2.0, 0.5)),
])
def test_solution_is_a_minimum(data, problem, way):
    train, dense, cls = data
    w, report = linear.fit(train.rows, 30, [problem], tol=1e-7)
    assert report.converged and report.passes > 0
    value, grad = objective(problem, w, dense, cls)
    assert np.abs(grad).max() < 1e-4
    # The gradient itself agrees with finite differences at another point.
    point = w + 0.3
    base, slope = objective(problem, point, dense, cls)
    for i in (0, 7, 30):
        step = np.zeros_like(point)
        step[i, 0] = 1e-6
        moved = objective(problem, point + step, dense, cls)[0]
        assert (moved - base) / 1e-6 == pytest.approx(slope[i, 0], rel=1e-3, abs=1e-3)


def test_reducers_and_groups_give_the_same(data, monkeypatch):
    train, _, _ = data
    problems = [p for f in range(5) for p in models.svc_problems(train.counts, f, 1.0)]
    want, _ = linear.fit(train.rows, 30, problems, 1e-6)
    monkeypatch.setattr(linear, "LOCAL_NUMBERS", -1)
    monkeypatch.setattr(linear, "MAX_GATHERED", 0)  # every pass through the block reducers
    monkeypatch.setattr(linear, "BLOCK", 50)
    assert linear.fit(train.rows, 30, problems, 1e-6)[0] == pytest.approx(want, abs=1e-4)
    monkeypatch.undo()
    monkeypatch.setattr(linear, "LOCAL_NUMBERS", -1)
    monkeypatch.setattr(linear, "MAX_COEFFICIENTS", 31 * 4)  # four problems at a time
    assert len(linear.groups(problems, 30)) == 4
    assert linear.fit(train.rows, 30, problems, 1e-6)[0] == pytest.approx(want, abs=1e-4)


def test_logistic_agrees_with_spark(data):
    train, _, _ = data
    mine = models.train_logistic(train, 2.0, tol=1e-8).weights
    other = models.train_spark_logistic(train, 2.0).weights
    centred = mine.copy()  # intercepts are only fixed up to a constant
    centred[-1] -= mine[-1].mean()
    other[-1] -= other[-1].mean()
    assert centred == pytest.approx(other, abs=2e-3)


def test_sigmoids_minimise_platt_loss(data, way):
    train, dense, cls = data
    model = models.train_calibrated_svcs(train, [0.5])[0]
    x = np.hstack([dense, np.ones((240, 1))])
    for j, (fold, k) in enumerate((f, k) for f in range(5) for k in range(3)):
        mine = np.arange(240) % 5 == fold
        f = (x @ model.weights[:, j])[mine]
        y = cls[mine] == k
        t = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
        a, b = model.sigmoids[j]
        p = 1 / (1 + np.exp(a * f + b))
        assert abs(((t - p) * f).sum()) < 1e-4 and abs((t - p).sum()) < 1e-4


def test_probabilities(data, spark):
    train, dense, cls = data
    model = models.train_calibrated_svcs(train, [0.5])[0]
    rows = linear.predict(train.rows.select("incident_id", "indices", "values"), model).orderBy("incident_id").collect()
    p = np.array([r.probabilities for r in rows])
    assert p.sum(axis=1) == pytest.approx(np.ones(240))
    assert (p.argmax(axis=1) == cls).mean() > 0.6
    decisions = dense @ model.weights[:-1] + model.weights[-1]
    assert p == pytest.approx(model.probabilities(decisions))


def test_too_few_rows_for_calibration(data):
    train, _, _ = data
    few = models.TrainingSet(train.rows.filter("cls < 2 OR incident_id < 6"), train.classes, train.counts, 30)
    with pytest.raises(ValueError):
        models.train_calibrated_svcs(few, [0.5])


def test_shipped_tolerance_gives_stable_decimals(data):
    train, _, _ = data
    rows = train.rows.select("incident_id", "indices", "values")
    for make in (lambda tol: models.train_calibrated_svcs(train, [0.5], tol=tol)[0], lambda tol: models.train_logistic(train, 2.0, tol)):
        shipped, exact = make(models.TOLERANCE), make(1e-7)
        assert shipped.converged and shipped.passes > 0
        a, b = ([r.probabilities for r in linear.predict(rows, m).orderBy("incident_id").collect()] for m in (shipped, exact))
        assert np.array(a) == pytest.approx(np.array(b), abs=5e-5)


def test_a_path_of_costs_gives_what_single_fits_give(data, way):
    train, _, _ = data
    problems = [p for c in (4.0, 0.25) for p in models.svc_problems(train.counts, -1, c)[:2]]
    together, report = linear.fit(train.rows, 30, problems, 1e-6)
    alone = np.hstack([linear.fit(train.rows, 30, [p], 1e-6)[0] for p in problems])
    assert report.converged and together == pytest.approx(alone, abs=1e-4)


def test_second_derivatives(data):
    _, dense, cls = data
    draw = np.random.default_rng(1)
    fold = np.arange(240) % 5
    for problem in (linear.Problem("binary", 0, 1, (2.0, 0.5)), linear.Problem("softmax", -1, 3, (1.0, 2.0, 0.5)),
                    linear.Problem("hinge", 1, 2, (2.0, 0.5))):
        f, z = draw.normal(size=(2, 240, problem.width))
        near = [linear.loss_and_factors(problem, f + s * 1e-6 * z, cls, fold)[1] for s in (-1, 1)]
        assert linear.curved(problem, f, z, cls, fold) == pytest.approx((near[1] - near[0]) / 2e-6, abs=1e-4)
        own = np.stack([linear.curved(problem, f, np.eye(problem.width)[[k] * 240], cls, fold)[:, k]
                        for k in range(problem.width)], 1)
        assert linear.bends(problem, f, cls, fold) == pytest.approx(own)


def test_a_fit_that_was_cut_short_says_so(data, way):
    train, _, _ = data
    _, report = linear.fit(train.rows, 30, [linear.Problem("hinge", 1, 2, (2.0, 0.5))], 1e-9, max_passes=2)
    assert report.passes == 2 and not report.converged


def test_folds_of_a_large_table_share_every_job(data, monkeypatch):
    train, _, _ = data
    settings = [(1.0, -1), (1.0, 0), (1.0, 3)]
    want = [m.weights for m in models.train_logistics(train, settings, 5)]
    runs, by_jobs = [], linear._fit_by_jobs
    monkeypatch.setattr(linear, "LOCAL_NUMBERS", -1)
    monkeypatch.setattr(linear, "_fit_by_jobs", lambda *args: runs.append(len(args[2])) or by_jobs(*args))
    found = models.train_logistics(train, settings, 5)
    assert runs == [3] and all(m.converged for m in found)
    for m, w in zip(found, want):
        assert m.weights == pytest.approx(w, abs=1e-3)


def test_dense_block_and_sparse_rest_give_the_same_products(monkeypatch):
    """F8: one softmax over 25 classes is one task, and its products were most of that task's time."""
    rng = np.random.default_rng(4)
    lengths = rng.integers(0, 12, 300)
    starts = np.r_[0, np.cumsum(lengths)]
    indices = np.concatenate([rng.choice(60, n, replace=False, p=1 / np.arange(1, 61) / (1 / np.arange(1, 61)).sum())
                              for n in lengths]).astype(np.int32)
    rows = linear.Rows(starts, indices, rng.random(len(indices)), {})
    w, f = rng.random((60, 7)), rng.random((300, 7))
    whole = np.zeros((300, 60))
    whole[np.repeat(np.arange(300), lengths), indices] = rows.values
    monkeypatch.setattr(linear, "NUMBERS_IN_CACHE", 100)
    assert rows.times(w) == pytest.approx(whole @ w)
    for numbers in (0, 300 * 5, 300 * 60):
        monkeypatch.setattr(linear, "DENSE_NUMBERS", numbers)
        dense = linear.Dense(rows, 60)
        assert dense.block.size <= numbers
        assert dense.times(w) == pytest.approx(whole @ w)
        assert dense.transposed_times(f, 60) == pytest.approx(whole.T @ f)
    none = linear.Dense(rows.where(np.zeros(300, bool))[0], 60)
    assert none.times(w).shape == (0, 7) and not none.transposed_times(f[:0], 60).any()


def test_targets_are_trained_together(spark, monkeypatch):
    """F8, F10, F13 to F15: each target's solver is one task, which used to wait for the other's."""
    from ticketloom.registry import training as registered

    both = threading.Barrier(2, timeout=20)
    monkeypatch.setattr(registered, "multi_tickets", lambda spark, sf: None)
    monkeypatch.setattr(registered.training, "train_multi", lambda tickets, target: (both.wait(), target)[1])
    assert registered.multi_models(spark, "no such folder") == ("service", "origine")
