"""Linear models: distributed sums over sparse rows, SVC, calibration, scoring.

Training rows are `(indices, values, cls, fold)`; one Spark job evaluates all
classes, folds and settings at once, and the driver only holds the coefficients.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators.joins import heavy_hitter_join
from ticketloom.session import materialise, ship_with_tasks

ship_with_tasks(__name__)

# Coefficients (features x problems) that one job may carry to each task.
MAX_COEFFICIENTS = 8_000_000
# Numbers that partitions may send to the driver in one pass.
MAX_GATHERED = 16_000_000
# Numbers one task works on at a time.
NUMBERS_PER_STEP = 4_000_000
# Products at hand at a time, so that they stay in a core's cache.
NUMBERS_IN_CACHE = 1 << 17
# Numbers of the fullest features that a task holds as a dense block, at most: 128 MB.
DENSE_NUMBERS = 16_000_000
# A feature is full if one row of so many has it.
FULL = 50
# Width of the partial sums that one reducer adds up.
BLOCK = 1 << 16


@dataclass
class Rows:
    """A batch of sparse rows in compressed form."""

    starts: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: dict[str, np.ndarray]

    @classmethod
    def of(cls, batch: pa.RecordBatch, names: list[str]) -> Rows:
        lists = batch.column("indices")
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return cls(
            starts,
            lists.flatten().to_numpy(zero_copy_only=False),
            batch.column("values").flatten().to_numpy(zero_copy_only=False),
            {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names},
        )

    def __len__(self) -> int:
        return len(self.starts) - 1

    def parts(self, budget: int, width: int) -> Iterator[Rows]:
        """Slices whose product with `width` columns stays within `budget` numbers."""
        per = max(1, budget // max(1, width))
        low = 0
        while low < len(self):
            high = int(np.searchsorted(self.starts, self.starts[low] + per, side="right")) - 1
            high = min(max(high, low + 1), len(self))
            a, b = self.starts[low], self.starts[high]
            yield Rows(
                self.starts[low : high + 1] - a, self.indices[a:b], self.values[a:b],
                {n: c[low:high] for n, c in self.columns.items()},
            )
            low = high

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Rows x weights, shape (rows, problems)."""
        out = np.zeros((len(self), weights.shape[1]))
        if weights.shape[1] == 1:
            filled = np.flatnonzero(np.diff(self.starts) > 0)
            if len(filled):
                out[filled, 0] = np.add.reduceat(weights[:, 0][self.indices] * self.values, self.starts[filled])
            return out
        at = 0
        for part in self.parts(NUMBERS_IN_CACHE, weights.shape[1]):
            filled = np.flatnonzero(np.diff(part.starts) > 0)
            if len(filled):
                products = weights[part.indices]
                products *= part.values[:, None]
                out[at + filled] = np.add.reduceat(products, part.starts[filled], axis=0)
            at += len(part)
        return out

    def where(self, mask: np.ndarray) -> tuple[Rows, np.ndarray]:
        """The marked rows, without their columns, and their numbers."""
        lengths = np.diff(self.starts)
        inside = np.repeat(mask, lengths)
        starts = np.concatenate([[0], np.cumsum(lengths[mask])])
        return Rows(starts, self.indices[inside], self.values[inside], {}), np.flatnonzero(mask)

    def transposed_times(self, factors: np.ndarray, size: int) -> np.ndarray:
        """Transposed rows x factors, shape (size, problems)."""
        lengths = np.diff(self.starts)
        out = np.zeros((size, factors.shape[1]))
        for j in np.flatnonzero(factors.any(axis=0)):
            out[:, j] = np.bincount(
                self.indices, weights=self.values * np.repeat(factors[:, j], lengths), minlength=size
            )
        return out


class Dense:
    """Rows at hand that meet many matrices: the fullest features as a dense block, of bounded size,
    the others sparse. A product is the same sum in another order."""

    def __init__(self, rows: Rows, size: int) -> None:
        n, lengths = len(rows), np.diff(rows.starts)
        count = np.bincount(rows.indices, minlength=size)
        first = np.argsort(-count, kind="stable")[: DENSE_NUMBERS // max(1, n)]
        self.full = np.sort(first[(count[first] > 0) & (count[first] * FULL >= n)])
        place = np.full(size, -1)
        place[self.full] = np.arange(len(self.full))
        place, owner = place[rows.indices], np.repeat(np.arange(n), lengths)
        inside = place >= 0
        self.block = np.bincount(
            owner[inside] * len(self.full) + place[inside], rows.values[inside], n * len(self.full)).reshape(n, len(self.full))
        starts = np.r_[0, np.cumsum(np.bincount(owner[~inside], minlength=n))]
        self.rest = Rows(starts, rows.indices[~inside], rows.values[~inside], {})

    def times(self, weights: np.ndarray) -> np.ndarray:
        return self.rest.times(weights) + self.block @ weights[self.full]

    def transposed_times(self, factors: np.ndarray, size: int) -> np.ndarray:
        out = self.rest.transposed_times(factors, size)
        out[self.full] = (factors.T @ self.block).T
        return out


def sum_over_rows(
    df: DataFrame, names: list[str], task: Callable[[Iterator[Rows]], np.ndarray], length: int,
    pieces: int,
) -> np.ndarray:
    """Sum the vectors of `length` that `task` makes of each of the `pieces` partitions.

    A partition sends its vector in blocks. As long as all of them together are
    small they are added up here; else every block has its own reducer, so no
    task and not the driver receives one vector per partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = task(Rows.of(b, names) for b in batches if b.num_rows)
        for block in range(0, length, BLOCK):
            yield pa.RecordBatch.from_pydict(
                {"block": [block], "part": [total[block : block + BLOCK]]}
            )

    parts = df.select("indices", "values", *names).mapInArrow(run, "block long, part array<double>")
    if pieces * length > MAX_GATHERED:
        parts = parts.groupBy("block").agg(
            vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part")
        )
    table = parts.toArrow()
    out = np.zeros(length)
    for block, part in zip(table.column("block").to_pylist(), table.column("part")):
        numbers = part.values.to_numpy()
        out[block : block + len(numbers)] += numbers
    return out


def partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


# ---------------------------------------------------------------------------
# Many regularised problems at once
# ---------------------------------------------------------------------------

HINGE, BINARY, SOFTMAX = "hinge", "binary", "softmax"


@dataclass(frozen=True)
class Problem:
    """One training problem on the rows outside fold `fold` (-1 uses all rows).

    hinge and binary: class `cls` against the rest, `cost` = (positive, other).
    softmax: all classes, `cost` per class. The hinge always penalises its intercept.
    """

    loss: str
    cls: int
    fold: int
    cost: tuple[float, ...]
    penalised_intercept: bool = False

    @property
    def width(self) -> int:
        return len(self.cost) if self.loss == SOFTMAX else 1


def spans(problems: list[Problem]) -> list[slice]:
    """The coefficient columns of each problem."""
    ends = np.cumsum([p.width for p in problems])
    return [slice(int(e) - p.width, int(e)) for e, p in zip(ends, problems)]


def loss_and_factors(
    problem: Problem, f: np.ndarray, cls: np.ndarray, fold: np.ndarray
) -> tuple[float, np.ndarray]:
    """Loss and its derivative by the decisions `f` (rows x width)."""
    used = fold != problem.fold
    if problem.loss == SOFTMAX:
        cost = np.asarray(problem.cost)[cls] * used
        z = f - f.max(axis=1, keepdims=True)
        e = np.exp(z)
        total = e.sum(axis=1)
        mine = np.arange(len(cls)), cls
        factors = e / total[:, None]
        factors[mine] -= 1.0
        return float((cost * (np.log(total) - z[mine])).sum()), factors * cost[:, None]
    positive = cls == problem.cls
    sign = np.where(positive, 1.0, -1.0)
    cost = np.where(positive, *problem.cost) * used
    margin = sign * f[:, 0]
    if problem.loss == HINGE:
        gap = np.maximum(0.0, 1.0 - margin)
        return float((cost * gap * gap).sum()), (-2.0 * cost * sign * gap)[:, None]
    loss = float((cost * np.logaddexp(0.0, -margin)).sum())
    return loss, (-cost * sign * _sigmoid(-margin))[:, None]


def bends(problem: Problem, f: np.ndarray, cls: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Second derivative of the loss by each decision alone (rows x width)."""
    used = fold != problem.fold
    if problem.loss == SOFTMAX:
        p = _softmax(f)
        return p * (1.0 - p) * (np.asarray(problem.cost)[cls] * used)[:, None]
    positive = cls == problem.cls
    cost = np.where(positive, *problem.cost) * used
    if problem.loss == HINGE:
        return (2.0 * cost * (np.where(positive, f[:, 0], -f[:, 0]) < 1.0))[:, None]
    p = _sigmoid(f[:, 0])
    return (cost * p * (1.0 - p))[:, None]


def curved(problem: Problem, f: np.ndarray, z: np.ndarray, cls: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Change of the loss's derivative as the decisions `f` move along `z` (rows x width)."""
    if problem.loss != SOFTMAX:
        return bends(problem, f, cls, fold) * z
    p = _softmax(f)
    cost = np.asarray(problem.cost)[cls] * (fold != problem.fold)
    return p * (z - (p * z).sum(axis=1, keepdims=True)) * cost[:, None]


def _softmax(f: np.ndarray) -> np.ndarray:
    e = np.exp(f - f.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


# ---------------------------------------------------------------------------
# What a solver asks of the data
# ---------------------------------------------------------------------------

@dataclass
class Ask:
    """The loss and its gradient at `w`; or, with `d`, the Hessian times `d`.

    The last row of `w` and `d` is the intercept. Answers are without the penalty.
    """

    problem: Problem
    w: np.ndarray
    d: np.ndarray | None = None


def _tally(batches: Iterator[Rows], asks: list[tuple[Problem, bool]], w: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """(losses, derivative along each column) summed over rows. `asks` tells for each problem
    whether it asks along its columns of `d`."""
    size, columns = w.shape[0] - 1, spans([p for p, _ in asks])
    loss, first = np.zeros(len(asks)), np.zeros_like(w)
    for batch in batches:
        for rows in batch.parts(NUMBERS_PER_STEP, w.shape[1]):
            cls, fold = rows.columns["cls"], rows.columns["fold"]
            f = rows.times(w[:-1]) + w[-1]
            z = rows.times(d[:-1]) + d[-1] if d.shape[1] else None
            factors = np.empty_like(f)
            for i, (problem, along) in enumerate(asks):
                own = f[:, columns[i]]
                if along:
                    factors[:, columns[i]] = curved(problem, own, z[:, columns[i]], cls, fold)
                else:
                    part, factors[:, columns[i]] = loss_and_factors(problem, own, cls, fold)
                    loss[i] += part
            first[:-1] += rows.transposed_times(factors, size)
            first[-1] += factors.sum(axis=0)
    return [loss, first]


def _stacked(asks: list[Ask]) -> tuple[list[tuple[Problem, bool]], np.ndarray, np.ndarray]:
    w = np.hstack([a.w for a in asks])
    along = any(a.d is not None for a in asks)
    d = np.hstack([np.zeros_like(a.w) if a.d is None else a.d for a in asks]) if along else w[:, :0]
    return [(a.problem, a.d is not None) for a in asks], w, d


def answer_by_job(df: DataFrame, asks: list[Ask], pieces: int) -> list:
    """All answers from one pass of Spark over the rows."""
    kinds, w, d = _stacked(asks)
    shared = df.sparkSession.sparkContext.broadcast((w, d))

    def task(batches: Iterator[Rows]) -> np.ndarray:
        return np.concatenate([x.ravel() for x in _tally(batches, kinds, *shared.value)])

    try:
        total = sum_over_rows(df, ["cls", "fold"], task, len(asks) + w.size, pieces)
    finally:
        shared.unpersist()
    first = total[len(asks) :].reshape(w.shape)
    return [
        first[:, c] if a.d is not None else (total[i], first[:, c])
        for i, (a, c) in enumerate(zip(asks, spans([p for p, _ in kinds])))
    ]


# ---------------------------------------------------------------------------
# Trust-region Newton
# ---------------------------------------------------------------------------

# Conjugate gradients stop at this part of the gradient, or after so many steps.
CG_ACCURACY = 0.3
CG_STEPS = 100


def newton(problem: Problem, start: np.ndarray, tol: float, reference: float | None):
    """Minimise half the squared norm plus the losses; a generator of asks.

    Steps come from conjugate gradients within a region in which the quadratic model is trusted
    (Lin, Weng and Keerthi 2008). Ends where the gradient is `tol` of `reference`, the norm at zero
    (None: `start` is zero). Returns (w, remaining, reference).
    """
    ridge = np.ones((len(start), 1))
    ridge[-1] = float(problem.loss == HINGE or problem.penalised_intercept)
    w = start
    loss, slope = yield Ask(problem, w)
    value, slope = loss + 0.5 * float((ridge * w * w).sum()), slope + ridge * w
    radius, stuck = float(np.linalg.norm(slope)), 0
    reference = radius if reference is None else reference
    while np.linalg.norm(slope) > tol * reference and stuck < 8:
        step, left, at_edge = np.zeros_like(w), -slope, False
        along, now = left, float((left * left).sum())
        goal = CG_ACCURACY * CG_ACCURACY * now
        for _ in range(CG_STEPS):
            if now <= goal:
                break
            bent = (yield Ask(problem, w, along)) + ridge * along
            size = now / float((along * bent).sum())
            further = step + size * along
            if np.linalg.norm(further) > radius:
                dd, sd, ss = (float((a * b).sum()) for a, b in ((along, along), (step, along), (step, step)))
                size = (np.sqrt(sd * sd + dd * (radius * radius - ss)) - sd) / dd
                step, left, at_edge = step + size * along, left - size * bent, True
                break
            step, left = further, left - size * bent
            before, now = now, float((left * left).sum())
            along = left + now / before * along
        expected = -0.5 * float((slope * step).sum() - (step * left).sum())
        there, length = w + step, float(np.linalg.norm(step))
        loss, new_slope = yield Ask(problem, there)
        new_value, new_slope = loss + 0.5 * float((ridge * there * there).sum()), new_slope + ridge * there
        fall = value - new_value
        # below rounding the values tell nothing, and the shorter gradient decides
        blurred = expected < 1e-11 * max(1.0, abs(value))
        good = np.linalg.norm(new_slope) < np.linalg.norm(slope) if blurred else fall > 1e-4 * expected
        if fall < 0.25 * expected and not blurred:
            radius = max(0.25, min(0.5, 0.5 * expected / max(expected - fall, 1e-300))) * length
        elif at_edge and fall > 0.75 * expected:
            radius *= 3.0
        if good:
            w, value, slope, stuck = there, new_value, new_slope, 0
        else:
            radius, stuck = min(radius, 0.25 * length), stuck + 1
    return w, float(np.linalg.norm(slope)) / reference if reference else 0.0, reference


def _times(a: tuple[float, ...], b: tuple[float, ...]) -> float | None:
    """The factor that makes `a` of `b`, if there is one."""
    factor = a[0] / b[0] if b[0] else None
    return factor if factor and np.allclose(a, np.array(b) * factor, rtol=1e-12) else None


def path(problems: list[Problem], size: int, tol: float, start: np.ndarray | None):
    """The same problem at several costs, each from the solution before; a generator of asks.

    Returns a list of (w, remaining gradient).
    """
    zero = np.zeros((size + 1, problems[0].width))
    out, w, reference = [], zero if start is None else start, None
    for at, problem in enumerate(problems):
        factor = _times(problem.cost, problems[at - 1].cost) if at else None
        if factor:
            reference *= factor  # at zero only the losses have a gradient
        elif w is not zero:
            _, slope = yield Ask(problem, zero)
            reference = float(np.linalg.norm(slope))
        w, remaining, reference = yield from newton(problem, w, tol, reference)
        out.append((w, remaining))
    return out


def groups(problems: list[Problem], size: int) -> list[list[Problem]]:
    """Problems in order, in groups whose coefficients fit the budget (at least one each)."""
    out: list[list[Problem]] = []
    room = 0
    for problem in problems:
        need = problem.width * (size + 1)
        if not out or need > room:
            out.append([])
            room = MAX_COEFFICIENTS
        out[-1].append(problem)
        room -= need
    return out


@dataclass
class Report:
    """How the problems of a fit ended: data passes, and the gradient that is left of each,
    relative to the one at the start."""

    passes: int
    remaining: list[float]
    tol: float

    @property
    def converged(self) -> bool:
        return all(r <= self.tol for r in self.remaining)


def paths(problems: list[Problem]) -> list[list[int]]:
    """Numbers of the problems that differ in cost only, cheapest first."""
    out: dict[tuple, list[int]] = {}
    for i, p in enumerate(problems):
        out.setdefault((p.loss, p.cls, p.fold, p.penalised_intercept, p.width), []).append(i)
    return [sorted(own, key=lambda i: sum(problems[i].cost)) for own in out.values()]


Start = dict[tuple, np.ndarray]  # first weights by (loss, cls, penalised_intercept)


def _start(starts: Start, p: Problem) -> np.ndarray | None:
    return starts.get((p.loss, p.cls, p.penalised_intercept))


def _whole(problems: list[Problem], own: list[list[int]]) -> list[Problem]:
    """For problems on several folds, the cheapest one of each class on all rows, to start from."""
    heads = [problems[o[0]] for o in own]
    found = {(p.loss, p.cls, p.penalised_intercept): replace(p, fold=-1) for p in reversed(heads)}
    return list(found.values()) if len({p.fold for p in heads}) > 1 else []


def _fit_by_jobs(
    df: DataFrame, size: int, problems: list[Problem], tol: float, max_passes: int, starts: Start
) -> tuple[list[tuple[np.ndarray, float]], int]:
    """Every pass over the data answers all problems that still run; groups beyond the coefficient
    budget run one after another."""
    own, pieces = paths(problems), partitions(df)
    done: list[tuple[np.ndarray, float]] = [None] * len(problems)
    most = 0
    heads = [problems[o[0]] for o in own]
    at = 0
    for group in groups(heads, size):
        running = {}
        for numbers in own[at : at + len(group)]:
            members = [problems[i] for i in numbers]
            for i in numbers:
                done[i] = np.zeros((size + 1, problems[i].width)), 1.0
            steps = path(members, size, tol, _start(starts, members[0]))
            running[tuple(numbers)] = steps, next(steps)
        at += len(group)
        passes = 0
        while running and passes < max_passes:
            passes += 1
            found = answer_by_job(df, [a for _, a in running.values()], pieces)
            for (numbers, (steps, ask)), answer in zip(list(running.items()), found):
                try:
                    running[numbers] = steps, steps.send(answer)
                except StopIteration as end:
                    del running[numbers]
                    for i, result in zip(numbers, end.value):
                        done[i] = result
        for numbers, (_, ask) in running.items():  # cut short: where they stand
            done[numbers[0]] = ask.w, 1.0
        most = max(most, passes)
    return done, most


def _alone(steps, rows: Rows, max_passes: int, size: int) -> tuple[list, int]:
    """A path on rows at hand. Decisions at one point serve all asks there, and only the rows on
    which the loss bends matter along a direction. Several columns at once are multiplied by a dense
    block of the rows outside the held-out fold."""
    passes, ask, result = 0, next(steps), None
    point = f = bent = None
    cls, fold = rows.columns["cls"], rows.columns["fold"]
    dense = None
    if ask.problem.width > 1:
        used = fold != ask.problem.fold  # a path has one fold
        dense, cls, fold = Dense(rows.where(used)[0], size), cls[used], fold[used]
    while passes < max_passes:
        passes += 1
        if point is not ask.w:
            point, f, bent = ask.w, _decisions(dense or rows, ask.w), None
        if ask.d is None:
            loss, factors = loss_and_factors(ask.problem, f, cls, fold)
            answer = loss, _back(dense or rows, factors, size)
        elif dense:
            answer = _back(dense, curved(ask.problem, f, _decisions(dense, ask.d), cls, fold), size)
        else:
            if bent is None:
                bent = rows.where(bends(ask.problem, f, cls, fold).any(axis=1))
            part, where = bent
            z = _decisions(part, ask.d)
            answer = _back(part, curved(ask.problem, f[where], z, cls[where], fold[where]), size)
        try:
            ask = steps.send(answer)
        except StopIteration as end:
            result = end.value
            break
    return result if result is not None else [(ask.w, 1.0)], passes


def _decisions(rows: Rows | Dense, w: np.ndarray) -> np.ndarray:
    return rows.times(w[:-1]) + w[-1]


def _back(rows: Rows | Dense, factors: np.ndarray, size: int) -> np.ndarray:
    return np.vstack([rows.transposed_times(factors, size), factors.sum(axis=0)])


# Numbers of a training table that may travel to the tasks whole: 96 MB. Then problems are what is
# dealt to the tasks; of larger tables, rows are.
LOCAL_NUMBERS = 8_000_000

_SOLVED = "problem int, weights binary, remaining double, passes int, a double, b double, settled boolean"


class _Shared:
    """A training table of checked size in all tasks, as plain arrays."""

    def __init__(self, df: DataFrame) -> None:
        table = df.select("indices", "values", "cls", "fold").toArrow().combine_chunks()
        if table.num_rows:
            rows = Rows.of(table.to_batches()[0], ["cls", "fold"])
            arrays = rows.starts, rows.indices.astype(np.int32), rows.values, rows.columns["cls"], rows.columns["fold"]
        else:
            arrays = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, int), np.zeros(0, int)
        self.spark = df.sparkSession
        self.arrays = self.spark.sparkContext.broadcast(arrays)

    @classmethod
    def if_small(cls, df: DataFrame) -> _Shared | None:
        numbers = df.agg(F.sum(F.size("indices") + 4)).first()[0] or 0
        return cls(df) if numbers <= LOCAL_NUMBERS else None

    def fit(self, size: int, problems: list[Problem], tol: float, max_passes: int, starts: Start,
            held: np.ndarray | None = None) -> list:
        """(weights, remaining, passes, a, b, settled) of each problem; one task a path."""
        own, arrays = paths(problems), self.arrays
        first = self.spark.sparkContext.broadcast([_start(starts, problems[o[0]]) for o in own])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, indices, values, cls, fold = arrays.value
            rows = Rows(at, indices, values, {"cls": cls, "fold": fold})
            for batch in batches:
                for number in batch.column("id").to_pylist():
                    members = [problems[i] for i in own[number]]
                    found, passes = _alone(path(members, size, tol, first.value[number]), rows, max_passes, size)
                    for i, (w, remaining) in zip(own[number], found):
                        a, b, settled = 0.0, 0.0, True
                        if held is not None:
                            mine = fold == problems[i].fold
                            f = _decisions(rows, w)[mine]
                            ab, settled = _platt(_held_sums(f, (cls[mine] == problems[i].cls)[:, None]), held[i : i + 1])
                            a, b = ab[0].tolist()
                        yield pa.RecordBatch.from_pydict({
                            "problem": pa.array([i], pa.int32()), "weights": [w.tobytes()], "remaining": [float(remaining)],
                            "passes": pa.array([passes], pa.int32()), "a": [a], "b": [b], "settled": [settled]})

        numbers = self.spark.range(0, len(own), 1, len(own))
        found = numbers.mapInArrow(task, _SOLVED).toArrow().to_pylist()
        first.unpersist()
        out: list = [(np.zeros((size + 1, p.width)), 1.0, 0, 0.0, 0.0, False) for p in problems]
        for r in found:
            w = np.frombuffer(r["weights"]).reshape(size + 1, -1)
            out[r["problem"]] = w, r["remaining"], r["passes"], r["a"], r["b"], r["settled"]
        return out

    def close(self) -> None:
        self.arrays.unpersist()


def _solve(df: DataFrame, size: int, problems: list[Problem], tol: float, max_passes: int, held: np.ndarray | None):
    """(weights, report, sigmoids, settled). Folds start from the solution on all rows."""
    whole = _whole(problems, paths(problems))
    shared = _Shared.if_small(df)
    if shared is None and all(p in problems for p in whole):
        whole = []  # folds need about as many passes from there as from zero, and all go on in one job
    keys = [(p.loss, p.cls, p.penalised_intercept) for p in whole]
    if shared is None:
        found, most = _fit_by_jobs(df, size, whole, tol, max_passes, {}) if whole else ([], 0)
        found, passes = _fit_by_jobs(df, size, problems, tol, max_passes, {k: w for k, (w, _) in zip(keys, found)})
        weights, report = np.hstack([w for w, _ in found]), Report(most + passes, [r for _, r in found], tol)
        sigmoids, settled = (None, True) if held is None else fit_sigmoids(df, weights, problems, held)
        return weights, report, sigmoids, settled
    try:
        found = shared.fit(size, whole, tol, max_passes, {}) if whole else []
        most = max((f[2] for f in found), default=0)
        found = shared.fit(size, problems, tol, max_passes, {k: f[0] for k, f in zip(keys, found)}, held)
    finally:
        shared.close()
    weights, remaining, passes, a, b, settled = zip(*found)
    return np.hstack(weights), Report(most + max(passes), list(remaining), tol), np.array([a, b]).T, all(settled)


def fit(
    df: DataFrame, size: int, problems: list[Problem], tol: float, max_passes: int = 2000
) -> tuple[np.ndarray, Report]:
    """Coefficients (size + 1) x columns of half the squared norm plus the weighted losses, and a report.

    Problems that differ in cost only follow each other as a path. A training table of checked
    size goes to the tasks and each solves a path; of a larger one, every pass answers all
    problems. Both are the same steps to the same optimum. The logistic losses penalise their
    intercept only where the problem says so.
    """
    return _solve(df, size, problems, tol, max_passes, None)[:2]


def fit_calibrated(
    df: DataFrame, size: int, problems: list[Problem], held: np.ndarray, tol: float, max_passes: int = 2000
) -> tuple[np.ndarray, Report, np.ndarray, bool]:
    """As `fit`, with a sigmoid (a, b) for each problem and whether all sigmoids reached their minimum.

    `held` holds (positive, other) held-out rows per problem.
    """
    return _solve(df, size, problems, tol, max_passes, held)


# ---------------------------------------------------------------------------
# Sigmoid calibration on held-out rows
# ---------------------------------------------------------------------------

def _platt_sums(f: np.ndarray, positive: np.ndarray, counts: np.ndarray, ab: np.ndarray) -> np.ndarray:
    """Loss, gradient and curvature (six rows) of decisions `f` (rows x problems) at `ab`."""
    high, low = (counts[:, 0] + 1.0) / (counts[:, 0] + 2.0), 1.0 / (counts[:, 1] + 2.0)
    target = np.where(positive, high, low)
    z = f * ab[:, 0] + ab[:, 1]
    p = _sigmoid(-z)
    loss = np.logaddexp(0.0, z) - (1.0 - target) * z
    gap, bend = target - p, p * (1.0 - p)
    return np.array([x.sum(0) for x in (loss, f * gap, gap, f * f * bend, f * bend, bend)])


def _held_sums(f: np.ndarray, positive: np.ndarray):
    return lambda ab, counts: _platt_sums(f, positive, counts, ab)


def _platt(sums, counts: np.ndarray, max_steps: int = 50) -> tuple[np.ndarray, bool]:
    """(a, b) per problem for P = 1 / (1 + exp(a f + b)) by Newton steps on `sums(ab, counts)`, and
    whether all reached their minimum. Targets are smoothed by the counts."""
    count = len(counts)

    def step_of(s: np.ndarray) -> np.ndarray:
        h11, h12, h22 = s[3] + 1e-12, s[4], s[5] + 1e-12
        det = h11 * h22 - h12 * h12
        det = np.where(np.abs(det) < 1e-300, 1e-300, det)
        return -np.stack([(h22 * s[1] - h12 * s[2]) / det, (h11 * s[2] - h12 * s[1]) / det], 1)

    ab = np.stack([np.zeros(count), np.log((counts[:, 1] + 1.0) / (counts[:, 0] + 1.0))], 1)
    best = sums(ab, counts)
    move, step = step_of(best), np.ones(count)
    open_ = np.hypot(best[1], best[2]) > 1e-7
    for _ in range(max_steps):
        if not open_.any():
            break
        trial = np.where(open_[:, None], ab + step[:, None] * move, ab)
        got = sums(trial, counts)
        slope = best[1] * move[:, 0] + best[2] * move[:, 1]
        fits = open_ & (got[0] <= best[0] + 1e-4 * step * slope + 1e-12)
        ab = np.where(fits[:, None], trial, ab)
        best = np.where(fits, got, best)
        move = np.where(fits[:, None], step_of(best), move)
        step = np.where(fits, 1.0, step * 0.5)
        open_ &= (np.hypot(best[1], best[2]) > 1e-7) & (step > 1e-8)
    return ab, bool((np.hypot(best[1], best[2]) <= 1e-6 * np.maximum(1.0, counts.sum(axis=1))).all())


def fit_sigmoids(
    df: DataFrame, weights: np.ndarray, problems: list[Problem], counts: np.ndarray
) -> tuple[np.ndarray, bool]:
    """(a, b) per problem, fitted on the rows of its own fold, by passes of Spark.

    Each row's decisions by the problems that held it out are written once; the passes read these.
    """
    fold = np.array([p.fold for p in problems])
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for rows in Rows.of(batch, ["cls", "fold"]).parts(NUMBERS_PER_STEP, len(problems)):
                for f in np.unique(rows.columns["fold"]):
                    own = np.flatnonzero(fold == f)
                    mine = rows.columns["fold"] == f
                    w = shared.value[:, own]
                    table = (rows.times(w[:-1]) + w[-1])[mine]
                    yield pa.RecordBatch.from_pydict({
                        "fold": pa.array([f], pa.int32()), "cls": [rows.columns["cls"][mine].astype(np.int64).tobytes()],
                        "decisions": [table.tobytes()]})

    held = materialise(df.select("indices", "values", "cls", "fold").mapInArrow(
        decide, "fold int, cls binary, decisions binary"), "held-out")
    shared.unpersist()
    kinds = np.array([p.cls for p in problems])

    def sums(ab: np.ndarray, counts: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((6, len(problems)))
            for batch in batches:
                for f, cls, decisions in zip(*(batch.column(c).to_pylist() for c in ("fold", "cls", "decisions"))):
                    own = np.flatnonzero(fold == f)
                    table = np.frombuffer(decisions).reshape(-1, len(own))
                    positive = np.frombuffer(cls, np.int64)[:, None] == kinds[own]
                    out[:, own] += _platt_sums(table, positive, counts[own], ab[own])
            yield pa.RecordBatch.from_pydict({"part": [out.tobytes()]})

        parts = held.mapInArrow(run, "part binary").toArrow()["part"].to_pylist()
        return sum((np.frombuffer(p).reshape(6, -1) for p in parts), np.zeros((6, len(problems))))

    return _platt(sums, counts)


# ---------------------------------------------------------------------------
# The fitted model
# ---------------------------------------------------------------------------

CALIBRATED, LOGISTIC = "calibrated", "logistic"


@dataclass
class LinearModel:
    """Classes and coefficients of a linear classifier.

    `calibrated`: one column per fold and class (one class if binary), each with a
    sigmoid; probabilities are normalised and averaged over folds.
    `logistic`: one column per class (softmax) or a single one (binary sigmoid).
    """

    kind: str
    classes: list[str]
    weights: np.ndarray = field(repr=False)  # (size + 1) x problems, intercept last
    sigmoids: np.ndarray | None = field(default=None, repr=False)
    folds: int = 1
    converged: bool = True
    passes: int = 0

    @property
    def size(self) -> int:
        return self.weights.shape[0] - 1

    def probabilities(self, decisions: np.ndarray) -> np.ndarray:
        """(rows, classes) from (rows, problems)."""
        if self.kind == LOGISTIC:
            if decisions.shape[1] == 1:
                p = _sigmoid(decisions)
                return np.hstack([1.0 - p, p])
            e = np.exp(decisions - decisions.max(axis=1, keepdims=True))
            return e / e.sum(axis=1, keepdims=True)
        raw = _sigmoid(-(decisions * self.sigmoids[:, 0] + self.sigmoids[:, 1]))
        raw = raw.reshape(len(raw), self.folds, -1)
        if raw.shape[2] == 1:
            raw = np.concatenate([1.0 - raw, raw], axis=2)
        else:
            total = raw.sum(axis=2, keepdims=True)
            even = np.full_like(raw, 1.0 / raw.shape[2])
            raw = np.divide(raw, total, out=even, where=total > 0)
        return raw.mean(axis=1)

    # -- tables -------------------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        """Coefficients as a table (feature, coefficients), the rest as one JSON line."""
        width = self.weights.shape[1]
        ends = pa.array(np.arange(len(self.weights) + 1, dtype=np.int32) * width)
        table = pa.table({
            "feature": pa.array(np.arange(len(self.weights), dtype=np.int32)),
            "coefficients": pa.ListArray.from_arrays(ends, pa.array(self.weights.ravel()))})
        spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/coefficients")
        meta = {
            "kind": self.kind, "classes": self.classes, "folds": self.folds,
            "converged": self.converged, "passes": self.passes,
            "sigmoids": None if self.sigmoids is None else self.sigmoids.tolist(),
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        rows = spark.read.parquet(f"{path}/coefficients").toArrow().sort_by("feature")
        table = np.array(rows.column("coefficients").to_pylist())
        sigmoids = None if meta["sigmoids"] is None else np.array(meta["sigmoids"])
        return cls(
            meta["kind"], meta["classes"], table, sigmoids, meta["folds"],
            meta.get("converged", True), meta.get("passes", 0))


def predict(features: DataFrame, model: LinearModel, out: str = "probabilities") -> DataFrame:
    """Add the class probabilities (array<double>, in class order). No shuffle."""
    keep = [c for c in features.columns if c not in ("indices", "values")]
    schema = T.StructType(
        [features.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.DoubleType()))]
    )
    shared = features.sparkSession.sparkContext.broadcast(model.weights)
    shell = replace(model, weights=np.zeros((1, 0)))  # the coefficients travel once, by broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [
                shell.probabilities(rows.times(w[:-1]) + w[-1])
                for rows in Rows.of(batch, []).parts(NUMBERS_PER_STEP, w.shape[1])
            ]
            table = np.vstack(found)
            ends = pa.array(np.arange(len(table) + 1) * table.shape[1], type=pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [lists], [*keep, out]
            )

    return features.select(*keep, "indices", "values").mapInArrow(run, schema)


def scores_by_join(
    weights: DataFrame, coefficients: DataFrame, small: bool, *by: str
) -> DataFrame:
    """(incident_id, *by, decision) from long features and a coefficient table.

    For models kept as a table `(term, *by, coef)`: the sum of coef * weight. Works for any
    number of features; the table is broadcast only when its size was checked, else the
    coefficients of frequent terms are and the rest is joined by hash.
    """
    if small:
        joined = weights.join(F.broadcast(coefficients), "term")
    else:
        packed = coefficients.groupBy("term").agg(F.collect_list(F.struct(*by, "coef")).alias("_of_term"))
        joined = heavy_hitter_join(materialise(weights, "weights"), packed, "term").select(
            "incident_id", "weight", F.inline("_of_term"))
    return (
        joined
        .groupBy("incident_id", *by)
        .agg(F.sum(F.col("coef") * F.col("weight")).alias("decision"))
    )
