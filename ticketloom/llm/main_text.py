"""The main text of web pages, by a linear-chain conditional random field over their leaf blocks.

A page is its sequence of leaf blocks (dom_blocks.py). A block's state, article or not, depends on
features of its ancestors' tags and names and of its own text, and on the state before it, by
whether both lie in one element. The field is trained on labelled pages: Spark sums the gradient of
the conditional likelihood over them, and L-BFGS on the driver, which holds only the weights, takes
the steps. Viterbi decoding finds the likeliest states of a whole page; no row is shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, columns_of
from ticketloom.llm.dom_blocks import SLOTS, Block, blocks_of
from ticketloom.llm.labelled_pages import MARK, labelled_page
from ticketloom.session import materialise

LABELLED = 2000  # so many labelled pages at most
TRAINING_PARTS = 4
ITERATIONS = 40
RIDGE = 0.05
_MEMORY = 7
# Behind a weight for every slot: the state of the first block, and two states by whether both
# blocks have one parent: [kind][state before][state].
_EXTRA = 2 + 8
_SIZE = SLOTS + _EXTRA
_SEQUENCE = "slots binary, cuts binary, kinds binary, truth binary"
_GRADIENT = "loss double, pages long, gradient binary"


def kinds_of(blocks: list[Block]) -> list[int]:
    """1 for a block with the parent of the block before it."""
    return [0, *(int(a.parent is b.parent) for a, b in zip(blocks, blocks[1:]))][: len(blocks)]


def _moves(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return weights[SLOTS : SLOTS + 2], weights[SLOTS + 2 :].reshape(2, 2, 2)


def likelihood(weights: np.ndarray, slots: np.ndarray, cuts: np.ndarray, kinds: np.ndarray,
               truth: np.ndarray, sizes: np.ndarray) -> tuple[float, np.ndarray]:
    """The negative log likelihood of the states of pages with `sizes` blocks and its gradient.

    Forward and backward sums go block by block, for all pages at once; pages are in order of size,
    so those that still have a block come first.
    """
    first, moves = _moves(weights)
    begin = np.cumsum(sizes) - sizes
    by_size = begin[np.argsort(-sizes, kind="stable")]
    longer = [int((sizes > t).sum()) for t in range(int(sizes.max()))]
    score = np.zeros((len(truth), 2))
    score[:, 1] = np.add.reduceat(weights[slots], cuts[:-1])
    steps = moves[kinds]  # block, state before, state
    ahead, back = score.copy(), np.zeros_like(score)
    ahead[begin] += first
    for t, n in enumerate(longer[1:], 1):
        at = by_size[:n] + t
        ways = ahead[at - 1][:, :, None] + steps[at]
        ahead[at] += np.logaddexp(ways[:, 0], ways[:, 1])
    for t in range(len(longer) - 2, -1, -1):
        at = by_size[: longer[t + 1]] + t
        ways = steps[at + 1] + (score[at + 1] + back[at + 1])[:, None, :]
        back[at] = np.logaddexp(ways[:, :, 0], ways[:, :, 1])
    last = begin + sizes - 1
    totals = np.logaddexp(ahead[last, 0], ahead[last, 1])
    total = np.repeat(totals, sizes)
    chance = np.exp(ahead + back - total[:, None])
    gradient = np.zeros(_SIZE)
    gradient[:SLOTS] = np.bincount(slots, np.repeat(chance[:, 1] - truth, np.diff(cuts)), SLOTS)
    gradient[SLOTS : SLOTS + 2] = (chance[begin] - np.eye(2)[truth[begin]]).sum(axis=0)
    inner = np.delete(np.arange(len(truth)), begin)
    pairs = np.exp(ahead[inner - 1][:, :, None] + steps[inner] + (score + back)[inner][:, None, :] - total[inner][:, None, None])
    pairs[np.arange(len(inner)), truth[inner - 1], truth[inner]] -= 1
    gradient[SLOTS + 2 :] = np.stack([pairs[kinds[inner] == k].sum(axis=0) for k in (0, 1)]).ravel()
    right = score[np.arange(len(truth)), truth].sum() + first[truth[begin]].sum() + steps[
        inner, truth[inner - 1], truth[inner]].sum()
    return float(totals.sum() - right), gradient


def viterbi(score: list[float], kinds: list[int], first: list[float], moves: list) -> list[int]:
    """The likeliest states, of which `score` is state 1's own; a tie goes to state 0."""
    zero, one, came = first[0], first[1] + score[0], []
    for own, kind in zip(score[1:], kinds[1:]):
        (to_00, to_01), (to_10, to_11) = moves[kind]
        from_0, from_1 = int(one + to_10 > zero + to_00), int(one + to_11 > zero + to_01)
        came.append((from_0, from_1))
        zero, one = max(zero + to_00, one + to_10), max(zero + to_01, one + to_11) + own
    states = [int(one > zero)]
    for pair in reversed(came):
        states.append(pair[states[-1]])
    return states[::-1]


def _laid_out(layouts: int):
    """Labelled pages with the texts of given ones, each in several layouts, as sequences of slots and states."""
    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c.split()[0]: [] for c in _SEQUENCE.split(", ")}
            for number, html in zip(*columns_of(batch, "number", "html")):
                texts = [b.text for b in blocks_of(html) if len(b.text) < 2000]
                for layout in range(layouts):
                    blocks = blocks_of(labelled_page(f"page {number} {layout}", texts), MARK)
                    if blocks:
                        slots = np.fromiter((s for b in blocks for s in b.features), np.int32)
                        cuts = np.cumsum([0, *(len(b.features) for b in blocks)], dtype=np.int32)
                        states = np.array([b.label for b in blocks], np.int32)
                        for name, row in zip(out, (slots, cuts, np.array(kinds_of(blocks), np.int32), states)):
                            out[name].append(row.tobytes())
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()) for k, v in out.items()})

    return lay_out


def joined(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Pages' (slots, cuts, kinds, truth) one after the other, and the number of blocks of each."""
    slots, cuts, kinds, truth = ([np.frombuffer(x, np.int32) for x in column] for column in zip(*rows))
    starts = np.cumsum([0, *map(len, slots)])
    ends = [c[1:] + s for c, s in zip(cuts, starts)]
    return (np.concatenate(slots), np.concatenate([[0], *ends]), np.concatenate(kinds), np.concatenate(truth),
            np.array(list(map(len, truth))))


def _gradient(shared):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, loss, pages, total = shared.value, 0.0, 0, np.zeros(_SIZE)
        for batch in batches:
            rows = list(zip(*columns_of(batch, "slots", "cuts", "kinds", "truth")))
            if rows:
                own, gradient = likelihood(weights, *joined(rows))
                loss, pages, total = loss + own, pages + len(rows), total + gradient
        yield pa.RecordBatch.from_pydict({"loss": [loss], "pages": [pages], "gradient": [total.tobytes()]})

    return sums


def _direction(gradient: np.ndarray, steps: list, changes: list) -> np.ndarray:
    """L-BFGS: the gradient times an approximate inverse Hessian of the last steps."""
    out, scales = -gradient, []
    for step, change in zip(reversed(steps), reversed(changes)):
        scale = step @ out / (step @ change)
        scales.append(scale)
        out = out - scale * change
    if steps:
        out = out * (steps[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    for step, change, scale in zip(steps, changes, reversed(scales)):
        out = out + step * (scale - change @ out / (step @ change))
    return out


def train(sequences: DataFrame, iterations: int = ITERATIONS) -> np.ndarray:
    """The field's weights for (slots, cuts, kinds, truth) rows; zeros if there are none."""
    context = sequences.sparkSession.sparkContext

    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast(weights)
        found = sequences.mapInArrow(_gradient(shared), _GRADIENT).collect()  # one row a part, TRAINING_PARTS of them
        shared.destroy()
        pages = max(1, sum(f.pages for f in found))
        gradient = sum((np.frombuffer(f.gradient) for f in found), np.zeros(_SIZE)) / pages
        return sum(f.loss for f in found) / pages + RIDGE / pages * weights @ weights, gradient + 2 * RIDGE / pages * weights

    weights = np.zeros(_SIZE)
    loss, gradient = at(weights)
    steps, changes = [], []
    for _ in range(iterations):
        direction = _direction(gradient, steps, changes)
        slope, length = float(gradient @ direction), 1.0 if steps else 1 / max(1.0, np.linalg.norm(gradient))
        if slope > -1e-8:
            break
        for _ in range(12):
            new_loss, new_gradient = at(weights + length * direction)
            if new_loss <= loss + 1e-4 * length * slope:
                break
            length /= 3
        step, change = length * direction, new_gradient - gradient
        weights, loss, gradient = weights + step, new_loss, new_gradient
        if step @ change > 1e-12:
            steps, changes = [*steps, step][-_MEMORY:], [*changes, change][-_MEMORY:]
    return weights


def training_sequences(pages: DataFrame, labelled: int = LABELLED, salt: str = "") -> DataFrame:
    """At most `labelled` labelled pages, laid out from the texts of pages chosen by a hash; of few
    pages each gives several."""
    spark = pages.sparkSession
    chosen = pages.select("html").where("html is not null").select(
        F.xxhash64(F.lit(salt), "html").alias("number"), "html")
    total = chosen.count()
    # a hash threshold first, so that few rows are sorted
    share = min(1.0, 2.0 * labelled / max(total, 1))
    if share < 1:
        chosen = chosen.where(F.col("number") < F.lit(int((2 * share - 1) * (1 << 63)) if share < 1 else 0))
    # copies of one page are one text; the smallest hashes are the sample
    chosen = chosen.dropDuplicates(["number"]).orderBy("number").limit(labelled)
    layouts = max(1, labelled // max(total, 1))
    found = chosen.repartition(TRAINING_PARTS, "number").mapInArrow(_laid_out(layouts), _SEQUENCE)
    return materialise(found, "labelled-pages").coalesce(TRAINING_PARTS)


_RESULT = "page_id long, url string, text string, n_chars long"


def _extractor(shared):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        first, moves = (x.tolist() for x in _moves(weights))
        own = weights[:SLOTS].tolist()
        known: dict[tuple, float] = {}
        for batch in batches:
            texts = []
            for html in batch.column("html").to_pylist():
                blocks = blocks_of(html or "")
                score = []
                for block in blocks:
                    if block.features not in known:
                        if len(known) > 50_000:
                            known.clear()
                        known[block.features] = sum(own[s] for s in block.features)
                    score.append(known[block.features])
                states = viterbi(score, kinds_of(blocks), first, moves) if blocks else []
                texts.append("\n".join(b.text for b, s in zip(blocks, states) if s))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array(map(len, texts), pa.int64())})

    return extract


def main_text(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages`: the article's blocks in page order.

    White space inside a block is one blank, blocks are joined by one line feed, character
    references are decoded, and no text is cut. Without `weights` the field is trained on at most
    LABELLED labelled pages made of the table's own texts. A null or empty page, and a page without
    an article, has an empty text. Rows with null or repeated ids, and copies of pages, keep their
    rows, and equal pages have equal texts. An empty table gives no rows. Columns besides `page_id`,
    `url` and `html` are not read.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    if weights is None:
        weights = train(training_sequences(own))
    return own.mapInArrow(_extractor(spark.sparkContext.broadcast(weights)), _RESULT)
