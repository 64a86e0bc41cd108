"""Exact ranks, splits and folds that never sort one whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.session import materialise

# Leading hex digits of an md5 that name a bucket: 16**4 buckets per group.
BUCKET_DIGITS = 4


def hash_order(id_col: str, seed: int) -> Column:
    """A deterministic pseudo-random order of rows."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def rank_in_group(
    df: DataFrame, group: list[str], order: Column, tie: str, out: str = "rn"
) -> DataFrame:
    """Add the 1-based rank of each row in its group, ordered by the md5 text `order`, then `tie`.

    A plain window would sort a whole group in one task. Here rows are counted
    per hash bucket, bucket counts are accumulated (at most 65,536 rows a
    group), and only the rows of one bucket are sorted together. Group columns
    must not be null.
    """
    keyed = df.withColumn("_order", order).withColumn(
        "_bucket", F.substring("_order", 1, BUCKET_DIGITS)
    )
    keys = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("_n"))
    offsets = counts.withColumn(
        "_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))
    ).drop("_n")
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("_order", tie))
    ranked = keyed.withColumn("_within", within)
    return ranked.join(offsets, keys).select(
        *[ranked[c] for c in df.columns],
        (F.col("_within") + F.col("_offset")).cast("long").alias(out),
    )


def largest_remainders(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, _quota): ceil(test_size * n) test rows in all, dealt to the classes in proportion.

    Each class gets the whole part of its share; the rows left go to the largest fractions, equal
    ones in label order. Shares are whole numbers over n, so no rounding decides. One row a class.
    """
    counts = df.groupBy(label).agg(F.count("*").cast("decimal(19,0)").alias("_n"))
    whole = Window.partitionBy(F.lit(0))  # class counts only
    share = counts.withColumn("_all", F.sum("_n").over(whole).cast("decimal(19,0)")).withColumn(
        "_test", F.ceil(F.lit(test_size) * F.col("_all").cast("double")).cast("decimal(19,0)"))
    parts = share.withColumn("_part", F.expr("(_test * _n) div _all")).withColumn(
        "_rest", F.expr("(_test * _n) % _all"))
    left = F.col("_test") - F.sum("_part").over(whole)
    place = F.row_number().over(whole.orderBy(F.desc("_rest"), label))
    return parts.withColumn("_left", left).withColumn("_place", place).select(
        label, (F.col("_part") + (F.col("_place") <= F.col("_left")).cast("long")).alias("_quota"))


def quota_cuts(
    df: DataFrame, group: list[str], id_col: str, test_size: float, seed: int, quotas: DataFrame | None = None
) -> DataFrame:
    """(group, _cut_order, _cut_id): the last row in hash order within ceil(test_size * n) of a group,
    or within its row of `quotas`; a group with a quota of 0 has no row.

    Counts per hash bucket tell in which bucket a group's quota ends; only the rows of that bucket
    are ranked, by hash and id alone.
    """
    order = hash_order(id_col, seed)
    keyed = df.select(*group, F.col(id_col).alias("_cut_id"), order.alias("_cut_order")).withColumn(
        "_bucket", F.substring("_cut_order", 1, BUCKET_DIGITS))
    counts = keyed.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = counts.withColumn("_upto", F.sum("_n").over(upto))
    if quotas is None:
        ends = ends.withColumn("_quota", F.ceil(F.lit(test_size) * F.sum("_n").over(whole)))
    else:
        ends = ends.join(quotas, group)
    before = F.col("_upto") - F.col("_n")
    last = ends.where((before < F.col("_quota")) & (F.col("_quota") <= F.col("_upto"))).select(
        *group, "_bucket", (F.col("_quota") - before).alias("_need"))
    within = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy("_cut_order", "_cut_id"))
    return keyed.join(last, [*group, "_bucket"]).withColumn("_rank", within).where(
        F.col("_rank") == F.col("_need")).select(*group, "_cut_order", "_cut_id")


def stratified_split(
    df: DataFrame, label: str, id_col: str = "incident_id", test_size: float = 0.2, seed: int = 42,
    exact: bool = False,
) -> DataFrame:
    """Add `is_test`: the first ceil(test_size * n) rows of each class in hash order.

    With `exact` the test rows of all classes together are ceil(test_size * n), dealt to the
    classes by largest remainders, so that a small class may have none.

    If a class has one row only, the split ignores classes. Rows are not moved: each is compared
    with its class's last test row.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    smallest = sizes.agg(F.min("_n")).first()[0]
    own = F.struct(hash_order(id_col, seed), F.col(id_col))
    if smallest is not None and smallest < 2:
        last = quota_cuts(df, [], id_col, test_size, seed).first()
        cut = F.struct(F.lit(last["_cut_order"]), F.lit(last["_cut_id"]).cast(df.schema[id_col].dataType))
        return df.withColumn("is_test", own <= cut)
    quotas = materialise(largest_remainders(df, label, test_size), "quotas") if exact else None
    cuts = materialise(quota_cuts(df, [label], id_col, test_size, seed, quotas), "cuts")
    joined = class_join(df, cuts, label, "left" if exact else "inner")
    is_test = F.coalesce(own <= F.struct("_cut_order", "_cut_id"), F.lit(False))
    return joined.select(*df.columns, is_test.alias("is_test"))


def folds(
    df: DataFrame, label: str, k: int, id_col: str = "incident_id", seed: int = 42
) -> DataFrame:
    """Add `fold` in 0..k-1, each class spread evenly."""
    ranked = rank_in_group(df, [label], hash_order(id_col, seed), id_col)
    return ranked.withColumn("fold", F.pmod(F.col("rn"), F.lit(k)).cast("int")).drop("rn")


def class_join(df: DataFrame, classes: DataFrame, label: str, how: str) -> DataFrame:
    """Join on a class label; class tables are size-checked like any dimension."""
    from ticketloom.operators.joins import dim_join

    return dim_join(df, classes, [label], how, F.col("incident_id"))
