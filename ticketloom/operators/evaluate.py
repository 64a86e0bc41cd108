"""Evaluation as aggregates over a (y, p) prediction table.

Every table beyond the first aggregate has at most classes x classes rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.constants import YES
from ticketloom.session import materialise

# Score ranges that split the ranking of an AUC; each is sorted on its own.
SCORE_RANGES = 1024


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def confusion(pred: DataFrame, *by: str) -> DataFrame:
    """(*by, y, p, n): the sparse confusion matrix; partial sums shrink hot cells map-side."""
    return pred.groupBy(*by, "y", "p").agg(F.count("*").alias("n"))


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))


def class_report(cells: DataFrame, *by: str) -> DataFrame:
    """(*by, class, precision, recall, f1, support) over true and predicted labels."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    true = cells.select(
        *by, F.col("y").alias("class"), hit.alias("tp"), F.col("n").alias("true"), zero.alias("pred")
    )
    predicted = cells.select(
        *by, F.col("p").alias("class"), zero.alias("tp"), zero.alias("true"), F.col("n").alias("pred")
    )
    sums = true.unionByName(predicted).groupBy(*by, "class").agg(
        F.sum("tp").alias("tp"), F.sum("true").alias("support"), F.sum("pred").alias("pred")
    )
    tp = F.col("tp")
    return sums.select(
        *by,
        "class",
        ratio(tp, F.col("pred")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("support") + F.col("pred")).alias("f1"),
        "support",
        "tp",
    )


def summary(pred: DataFrame, *by: str) -> DataFrame:
    """(*by, accuracy, f1_macro, f1_weighted, n) in one pass over the predictions."""
    report = class_report(confusion(pred, *by), *by)
    return report.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.sum("support").alias("n"),
    )


def full_report(pred: DataFrame, weak: float = 0.5) -> DataFrame:
    """Per-class rows by support, plus accuracy, macro and weighted averages.

    `is_weak` flags classes with F1 below `weak`.
    """
    report = class_report(confusion(pred))
    rows = report.select(
        F.col("class").cast("string").alias("class"),
        "precision", "recall", "f1", "support", (F.col("f1") < weak).alias("is_weak"),
    )
    total = F.sum("support").alias("support")
    no = F.lit(None).cast("boolean").alias("is_weak")

    def weighted(name: str) -> Column:
        return (F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(name)

    hit_rate = F.sum("tp") / F.sum("support")
    extra = [
        report.agg(
            F.lit("accuracy").alias("class"), hit_rate.alias("precision"),
            hit_rate.alias("recall"), hit_rate.alias("f1"), total, no,
        ),
        report.agg(
            F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
            F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total, no,
        ),
        report.agg(
            F.lit("weighted avg").alias("class"), weighted("precision"), weighted("recall"),
            weighted("f1"), total, no,
        ),
    ]
    for part in extra:
        rows = rows.unionByName(part)
    return rows


def by_support(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("support"), "class")


def frequent_confusions(pred: DataFrame, more_than: int = 5) -> DataFrame:
    return confusion(pred).filter((F.col("y") != F.col("p")) & (F.col("n") > more_than))


def binary_counts(pred: DataFrame) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col("y") == 1, F.col("p") == 1
    return pred.agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
    )


def roc_auc(pred: DataFrame, *by: str) -> DataFrame:
    """(*by, auc) from 0/1 `y` and `score`: the exact rank statistic, ties at half weight.

    Rows collapse to distinct scores first. Negatives below a score are counted
    as whole score ranges plus a window inside one range, so no task sorts all
    scores; the ranges come from distributed quantiles.
    """
    scores = pred.groupBy(*by, "score").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    scores = materialise(scores, "scores")  # read twice: for the ranges and the ranks
    cuts = scores.approxQuantile(
        "score", [i / SCORE_RANGES for i in range(1, SCORE_RANGES)], 0.25 / SCORE_RANGES
    )
    inner = sorted(set(cuts)) or [0.0]
    ranged = Bucketizer(
        splits=[float("-inf"), *inner, float("inf")], inputCol="score", outputCol="range"
    ).transform(scores)
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*by, "range").agg(F.sum("neg").alias("_neg")).select(
        *by, "range", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("below")
    )
    inside = Window.partitionBy(*by, "range").orderBy("score").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = ranged.withColumn("here", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    joined = counted.join(offsets, [*by, "range"])
    won = F.col("pos") * (F.col("below") + F.col("here") + F.col("neg") / 2)
    return joined.groupBy(*by).agg(
        F.try_divide(F.sum(won), F.sum("pos") * F.sum("neg")).alias("auc")  # null for one class
    )


def label_balance(tickets: DataFrame, target: str = "omv") -> DataFrame:
    """Rows, yes and no counts and shares."""
    yes = F.count_if(F.col(target) == YES)
    n = F.count("*")
    return tickets.agg(
        n.alias("n"), yes.alias("n_yes"), (n - yes).alias("n_no"),
        ratio(yes, n).alias("share_yes"), ratio(n - yes, n).alias("share_no"),
    )


def lookup_coverage(tickets: DataFrame) -> DataFrame:
    """Known and unknown requesters, as counts and percent."""
    known, n = F.count("service_deterministe"), F.count("*")
    pct = F.when(n == 0, F.lit(0.0)).otherwise(known * 100.0 / n)
    return tickets.agg(
        n.alias("n"), known.alias("known"), (n - known).alias("unknown"),
        pct.alias("pct_known"), (F.lit(100.0) - pct).alias("pct_unknown"),
    )


def labelled_counts(tickets: DataFrame, *targets: str) -> DataFrame:
    return tickets.agg(*[F.count(t).alias(f"n_{t}") for t in targets])


# Sketches have 2 to this power buckets; three standard errors of an estimate are 1.04 * 3 / 64, under 5%.
SKETCH_BUCKETS = 12
SKETCH_ERROR = 0.05


def distinct_sketches(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """(*by, column_name, sketch): one sketch of a few KB for each part and column, however many values.

    Sketches of parts and runs may be kept and merged later, in any order.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BUCKETS)).alias(c) for c in columns]
    wide = df.groupBy(*by).agg(*sketches)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("sketch")) for c in columns])
    return wide.select(*by, F.inline(cells))


def distinct_estimates(sketches: DataFrame, *by: str) -> DataFrame:
    """(*by, column_name, estimate) of sketches merged over all that is not in `by`."""
    return sketches.groupBy(*by, "column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
