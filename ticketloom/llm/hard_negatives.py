"""Hard negatives for anchors and their positives, by slots between the positives' scores.

An anchor's positives are its best rows of the same label. A positive with score p accepts
negatives with scores from `low` to `high` percent of p, so the windows of one anchor overlap and
have one upper limit each. The upper limits cut the scores into disjoint slots. A slot's k best rows
are all that any window can need of it: a window's answer is the beginning of its own slot and the
slots below it, taken in descending order and cut at its lower limit. So every row is compared once
for each anchor and kept in at most one slot, whatever the number of overlapping windows.

Rows stay where they are. Anchors go to them in pieces of bounded size, one piece after the other;
a task multiplies blocks of rows with the piece and passes on at most k rows of each slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches
from ticketloom.session import materialise, scratch_path

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE = 256
# A piece of anchors holds so many vector components at most: 32 MB.
PIECE_VALUES = 1 << 22
STEP = 256  # rows that are compared with a piece at once
_SALTS = 64
_LEAST = np.iinfo(np.int64).min
_EXACT = 1 << 53  # below it a product in double precision is exact

_FOUND = "anchor int, slot int, id long, score long"
_FOUND_ARROW = pa.schema([("anchor", pa.int32()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def quantised(vector: str, scale: int = SCALE) -> Column:
    """Each component x as floor(scale * x); null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(~bad, whole)


def matrix(vectors: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of `left` with all rows of `right`."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    high = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(width, 1)
    if high < _EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    out = left.astype(object) @ right.T.astype(object) if high > -_LEAST - 1 else left @ right.T
    return out.astype(np.int64)  # raises where a score is no long


class Best:
    """The k best rows of each of n lists: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.list = np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.floor = np.full(n, _LEAST)  # of full lists the last score, of others the least number

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = scores >= self.floor[lists]
        if not fit.any():
            return
        lists = np.concatenate([self.list, lists[fit]])
        scores, ids = np.concatenate([self.score, scores[fit]]), np.concatenate([self.id, ids[fit]])
        order = np.lexsort((ids, ~scores, lists))  # ~x falls as x rises, for every long
        lists, scores, ids = lists[order], scores[order], ids[order]
        begin = np.searchsorted(lists, np.arange(self.n))
        rank = np.arange(len(lists)) - begin[lists]
        self.floor[lists[rank == self.k - 1]] = scores[rank == self.k - 1]
        kept = rank < self.k
        self.list, self.score, self.id = lists[kept], scores[kept], ids[kept]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, STEP):
            part = batch.slice(first, STEP)
            yield part.column("id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("vector"))


def _found(best: Best, slots: int) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([
        pa.array(best.list // slots, pa.int32()), pa.array(best.list % slots, pa.int32()),
        pa.array(best.id), pa.array(best.score)], schema=_FOUND_ARROW)


def _same_label(piece, k: int):
    """The k best rows of each anchor's label, the anchor itself among them if it is one of these."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, vectors = piece.value[:2]
        best = Best(len(labels), k)
        for ids, own, rows in _blocks(batches):
            anchor, row = np.nonzero(labels[:, None] == own[None, :])
            best.offer(anchor, products(vectors, rows)[anchor, row], ids[row])
        yield from _found(best, 1)

    return find


def _other_labels(piece, k: int):
    """The k best rows of each slot; `upper` and `lower` have the limits of an anchor's windows, descending."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, vectors, upper, lower = piece.value
        slots = upper.shape[1]
        best = Best(len(labels) * slots, k)
        for ids, own, rows in _blocks(batches):
            scores = products(vectors, rows)
            free = labels[:, None] != own[None, :]
            for slot in range(slots):
                # what is below the lower limit of the slot's own window is below those of all higher ones
                least = np.maximum(lower[:, slot], best.floor.reshape(-1, slots)[:, slot])
                fit = free & (scores <= upper[:, slot, None]) & (scores >= least[:, None])
                if slot + 1 < slots:
                    fit &= scores > upper[:, slot + 1, None]
                anchor, row = np.nonzero(fit)
                if len(anchor):
                    best.offer(anchor * slots + slot, scores[anchor, row], ids[row])
        yield from _found(best, slots)

    return find


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each slot over all tasks, in two steps so that no list meets in one task at once."""
    order = [F.desc("score"), F.asc("id")]
    salted = found.withColumn("salt", F.spark_partition_id() % _SALTS)
    few = salted.withColumn("n", F.row_number().over(
        Window.partitionBy("anchor", "slot", "salt").orderBy(*order))).where(F.col("n") <= k)
    return few.withColumn("n", F.row_number().over(
        Window.partitionBy("anchor", "slot").orderBy(*order))).where(F.col("n") <= k)


def _pieces(anchors: DataFrame, width: int) -> list[tuple[int, int]]:
    """Ranges of `place` with at most PIECE_VALUES components each.

    Places count up within each part of the table (the lower 33 bits), so the parts' row numbers
    tell every range without looking at the rows.
    """
    size = max(1, PIECE_VALUES // max(1, width))
    parts = anchors.groupBy(F.shiftright("place", 33).alias("part")).count().collect()
    ranges: list[tuple[int, int]] = []
    start, held = 0, 0
    for part, count in sorted(parts):
        done = 0
        while done < count:
            step = min(size - held, count - done)
            held, done = held + step, done + step
            if held == size:
                end = (part << 33) + done
                ranges.append((start, end))
                start, held = end, 0
    if held:
        ranges.append((start, 1 << 62))
    return ranges


def _without_self(best: list[tuple[int, int]], own: tuple[int, int], k: int) -> list[tuple[int, int]]:
    """One entry that is the anchor itself goes; entries of copies are alike, so any one of them does."""
    if own in best:
        best.remove(own)
    return best[:k]


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (id, label, vector).

    `anchor` is the condition that makes a row an anchor. Vectors are whole numbers; a score is the
    inner product with the anchor, of vectors of unequal length over the components both have; a score that is
    no long stops the job. Positives are the first `positives` other rows of the anchor's label,
    negatives the first `negatives` rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score, higher scores first, ties by smaller id; fewer if
    there are fewer. Rows with a null id, label, vector or component take no part. A repeated row
    counts as often as it occurs, as an anchor too. Without rows or anchors the result is empty.
    Other columns are not read.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    whole = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    own = rows.select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    table = materialise(own.where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole), "vectors")
    chosen = materialise(
        table.where("anchor").select(F.monotonically_increasing_id().alias("place"), "id", "label", "vector"), "anchors")
    table = table.select("id", "label", "vector")
    width = chosen.agg(F.max(F.size("vector"))).first()[0] or 0
    path = scratch_path(spark, "hard-negatives")
    spark.createDataFrame([], _RESULT).write.parquet(path)
    for start, end in _pieces(chosen, width):
        piece = chosen.where((F.col("place") >= start) & (F.col("place") < end)).drop("place").toArrow()
        ids, labels = piece.column("id").to_numpy(), piece.column("label").to_numpy()
        vectors = matrix(piece.column("vector"))
        _mine(table, ids, labels, vectors, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)


_KNOWN = """anchor int, anchor_id long,
    positives array<struct<positive_id:long,positive_score:long,lower:long,upper:long>>"""
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mine(table: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, positives: int,
          negatives: int, low: int, high: int) -> DataFrame:
    """The result for one piece of anchors, all arrays of bounded size."""
    spark = table.sparkSession
    context = spark.sparkContext
    shared = context.broadcast((labels, vectors))
    best = _merged(table.mapInArrow(_same_label(shared, positives + 1), _FOUND), positives + 1)
    lists: list[list[tuple[int, int]]] = [[] for _ in ids]
    for anchor, ident, score in best.select("anchor", "id", "score").orderBy("anchor", "n").collect():
        lists[anchor].append((ident, score))
    own = [int(sum(int(x) * int(x) for x in v)) for v in vectors]
    lists = [_without_self(x, (int(i), s), positives) for x, i, s in zip(lists, ids, own)]
    windows = [[(-(-s * low // 100), s * high // 100) for _, s in found] for found in lists]
    lower, upper = (np.full((len(ids), positives), x) for x in (-_LEAST - 1, _LEAST))
    for at, found in enumerate(windows):
        lower[at, : len(found)], upper[at, : len(found)] = [w[0] for w in found], [w[1] for w in found]
    shared = context.broadcast((labels, vectors, upper, lower))
    slots = _merged(table.mapInArrow(_other_labels(shared, negatives), _FOUND), negatives)
    # slots in order hold descending scores, so the sorted list is the merge of all suffixes
    merged = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct("slot", (-F.col("score")).alias("lowest"), "id", "score"))).alias("candidates"))
    known = spark.createDataFrame(
        [(at, int(i), [(*p, *w) for p, w in zip(x, y)]) for at, (i, x, y) in enumerate(zip(ids, lists, windows))], _KNOWN)
    pairs = known.join(merged, "anchor").select("anchor_id", F.explode("positives").alias("p"), "candidates")
    window = F.slice(F.filter("candidates", lambda c: c["score"].between(F.col("p.lower"), F.col("p.upper"))), 1, negatives)
    ranked = pairs.select("anchor_id", "p.*", F.posexplode(window).alias("at", "c"))
    return ranked.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("c.id").alias("negative_id"),
                         "positive_score", F.col("c.score").alias("negative_score"))
