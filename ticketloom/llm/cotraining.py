"""A quality classifier trained on two views that teach each other.

One view is the text: its words and the ends of its words. The other is what is known about the
page: source, language, length. Each view has its own logistic regression. In each round both score
all unlabelled documents, and every confident label of one view becomes a training row of the other.
At the end each view's margin is calibrated on labelled rows that no round has used, and the
calibrated log odds are added up, less the prior that both contain.

Labelled rows are a sample of bounded size, in the order of a hash of the id. Both views of all
documents are written once as vectors; every round and the last scoring read these. Unlabelled
documents are scored and taught where they are, row by row: nothing of them is sampled or sorted, and
only rows whose id may be among the labels' are joined.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import fresh_name, touched
from ticketloom.session import materialise

LABELLED = 20_000  # at most so many labelled rows
CALIBRATE = 4  # every so many-th labelled row, by hash, is kept for calibration
ROUNDS = 2
CONFIDENT = 0.95
# The driver makes several vectors of so many numbers a step; they stay small, so that its memory does.
TEXT_SLOTS = 60_000
PAGE_SLOTS = 1 << 12
REGULARISATION = 1e-4
ITERATIONS = 30
ACCURACY = 1e-4  # of the loss, between two steps
VIEWS = ("text", "page")


def _terms(docs: DataFrame, metadata: list[str]) -> DataFrame:
    """(doc_id, pool, text_terms, page_terms)"""
    words = F.array_remove(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    ends = F.transform(words, lambda w: F.concat(F.lit("~"), F.right(w, F.lit(3))))
    length = F.floor(2 * F.log2(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + 1))
    page = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in metadata]
    return docs.select(
        "doc_id", "pool", F.concat(F.transform(words, F.lower), ends).alias("text_terms"),
        F.array(*page, F.concat(F.lit("length="), length.cast("string"))).alias("page_terms"))


def features(docs: DataFrame, metadata: list[str]) -> DataFrame:
    """(doc_id, pool, text, page): both views as sparse vectors of the terms that occur."""
    out = _terms(docs, metadata)
    for view, slots in zip(VIEWS, (TEXT_SLOTS, PAGE_SLOTS)):
        out = HashingTF(inputCol=f"{view}_terms", outputCol=view, numFeatures=slots, binary=True).transform(out)
    return out.select("doc_id", "pool", *VIEWS)


def _by_hash(rows: DataFrame, limit: int) -> DataFrame:
    """The `limit` rows that come first by a hash of the id; a bound on the hash leaves few to sort."""
    place = F.xxhash64(F.lit("sample"), "doc_id")
    share = min(1.0, 2.0 * limit / max(rows.count(), 1))
    if share < 1:
        rows = rows.where(place < F.lit(int((2 * share - 1) * (1 << 63))))
    return rows.orderBy(place, "doc_id").limit(limit)


class CoTrained:
    """Both views' models, their calibration (slope, offset), and the log odds of the prior."""

    def __init__(self, models: dict[str, LogisticRegressionModel], lines: dict[str, tuple[float, float]], prior: float) -> None:
        self.models, self.lines, self.prior = models, lines, prior

    def scored(self, rows: DataFrame) -> DataFrame:
        """(doc_id, text_score, page_score, score) of (doc_id, text, page)."""
        odds: dict[str, Column] = {v: F.lit(self.prior) for v in VIEWS}
        for view, model in self.models.items():
            rows = _margin(model, view, rows)
            slope, offset = self.lines[view]
            odds[view] = F.col(f"{view}_margin") * slope + offset
        both = odds["text"] + odds["page"] - self.prior
        chance = {"text_score": odds["text"], "page_score": odds["page"], "score": both}
        return rows.select("doc_id", *[F.round(1 / (1 + F.exp(-o)), 6).alias(c) for c, o in chance.items()])


def _margin(model: LogisticRegressionModel, view: str, rows: DataFrame) -> DataFrame:
    scored = model.setFeaturesCol(view).setRawPredictionCol("raw").setProbabilityCol("").setPredictionCol("").transform(rows)
    return scored.withColumn(f"{view}_margin", vector_to_array("raw")[1]).drop("raw")


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(
        featuresCol=view, labelCol="y", maxIter=ITERATIONS, tol=ACCURACY, regParam=REGULARISATION, standardization=False,
        aggregationDepth=2).fit(rows)


def _line(rows: DataFrame, margin: str) -> tuple[float, float]:
    """Platt's slope and offset for a margin."""
    rows = VectorAssembler(inputCols=[margin], outputCol="x").transform(rows)
    model = LogisticRegression(featuresCol="x", labelCol="y", maxIter=50, regParam=1e-3, standardization=False).fit(rows)
    return float(model.coefficients[0]), float(model.intercept)


def _taught(pool: DataFrame, models: list[LogisticRegressionModel], view: str) -> DataFrame:
    """(doc_id, text, page, y): the rows that a view was sure of in any round, by the first that was."""
    margin, sure = F.col(f"{view}_margin"), math.log(CONFIDENT / (1 - CONFIDENT))
    rows = pool.select("doc_id", *VIEWS, F.lit(None).cast("double").alias("y"))
    for model in models:
        label = F.when(margin >= sure, 1.0).when(margin <= -sure, 0.0)
        rows = _margin(model, view, rows).select("doc_id", *VIEWS, F.coalesce("y", label).alias("y"))
    return rows.where("y is not null")


# Whether a row teaches as unlabelled: never, as it is, or as one of the rows with its id.
NEVER, ALONE, REPEATED = 0, 1, 2


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with `pool`, one of the marks above. Only rows whose id may be labelled or repeated move."""
    own = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    labelled = labels.select("doc_id", F.lit(NEVER).alias("mark"))
    repeated = own.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(REPEATED).alias("mark"))
    marks = labelled.union(repeated).where("doc_id is not null").groupBy("doc_id").agg(F.min("mark").alias("mark"))
    marks = materialise(marks, "marked-ids")
    maybe, free = touched(own, marks, "doc_id")
    other = fresh_name(own, "marked_id")
    marks = marks.select(F.col("doc_id").alias(other), F.col("mark").alias("pool"))
    maybe = maybe.join(marks, F.col("doc_id") == F.col(other), "left").drop(other)
    alone = F.when(F.col("doc_id").isNull(), NEVER).otherwise(ALONE)
    return free.withColumn("pool", alone).unionByName(maybe.withColumn("pool", F.coalesce("pool", alone)))


def train(vectors: DataFrame, labels: DataFrame) -> CoTrained:
    """Co-train on (doc_id, pool, text, page) and (doc_id, y) labels, of which 1 stands for a document worth keeping."""
    known = labels.where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
    sample = F.broadcast(materialise(_by_hash(materialise(known, "judged"), LABELLED), "labelled"))  # of bounded size
    # a repeated id counts once
    labelled = materialise(vectors.where(F.col("pool") == NEVER).join(sample, "doc_id").dropDuplicates(["doc_id"]), "training")
    aside = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATE)) == 0
    fit, held = labelled.where(~aside), labelled.where(aside)
    counts = labelled.agg(F.count("*"), F.sum("y")).first()
    total, good = counts[0], counts[1] or 0.0
    prior = math.log((good + 1) / (total - good + 1))
    if any(part.select("y").distinct().count() < 2 for part in (fit, held)):
        return CoTrained({}, {}, prior)
    several = vectors.where(F.col("pool") == REPEATED).dropDuplicates(["doc_id"])
    pool = vectors.where(F.col("pool") == ALONE).union(materialise(several, "repeated"))
    own = fit.select("doc_id", *VIEWS, "y")
    taught = {view: own for view in VIEWS}
    made: dict[str, list[LogisticRegressionModel]] = {view: [] for view in VIEWS}
    for step in range(ROUNDS + 1):
        models = {view: _fit(taught[view].select(view, "y"), view) for view in VIEWS}
        # Spark drops a fit's broadcasts and shuffle files only after the driver has collected its garbage
        vectors.sparkSession._jvm.System.gc()
        if step == ROUNDS:
            break
        for view, other in (VIEWS, VIEWS[::-1]):
            made[view].append(models[view])
            taught[other] = own.union(_taught(pool, made[view], view))
    lines = {view: _line(_margin(models[view], view, held), f"{view}_margin") for view in VIEWS}
    return CoTrained(models, lines, prior)


def classify(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """(doc_id, text_score, page_score, score, kept) for each row of `docs`.

    `labels` has doc_id, quality and toxic; a document is worth keeping if its quality is 1 and it
    is not toxic (a null quality is no label, a null toxic is not toxic). Scores are chances of
    being worth keeping, kept means at least one half. Repeated labels of one id count as the worst
    of them, unlabelled rows that repeat an id teach once. Without labels of both
    classes every score is the labels' share of good ones. Null texts count as empty and null
    metadata as a value of its own; null ids are scored but train nothing. Very long texts count
    whole; an empty table gives no rows. Columns besides `doc_id`, `text` and the metadata are not read; metadata that `docs`
    lacks is left out.
    """
    present = [c for c in metadata if c in docs.columns]
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    judged = labels.select(F.col("doc_id").cast("long").alias("doc_id"), good.cast("double").alias("y"))
    docs = docs.select("doc_id", "text", *present)
    vectors = materialise(features(_marked(docs, judged.where("y is not null")), present), "vectors")
    return train(vectors, judged).scored(vectors).withColumn("kept", F.col("score") >= 0.5)
