"""Which rows take part: trainable rows, frequent classes, rows to score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.constants import YES
from ticketloom.functions.fields import is_ruled_out
from ticketloom.operators.ranking import class_join
from ticketloom.session import materialise


def trainable(tickets: DataFrame, target: str, only_yes: bool = False) -> DataFrame:
    """Rows with a label and a description; `only_yes` keeps true interventions."""
    keep = F.col(target).isNotNull() & (F.col("description") != "")
    if only_yes:
        keep &= F.col("omv") == YES
    return tickets.filter(keep)


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n"))


def frequent_classes(df: DataFrame, target: str, min_samples: int) -> DataFrame:
    """Rows whose class has at least `min_samples` rows."""
    valid = class_counts(df, target).filter(F.col("n") >= min_samples).select(target)
    valid = materialise(valid, "classes")  # read for its size and for the join
    return class_join(df, valid, target, "left_semi")


def rare_classes(df: DataFrame, target: str, min_samples: int) -> DataFrame:
    """Ignored classes with their volume, largest first."""
    return (
        class_counts(df, target)
        .filter((F.col("n") < min_samples) & F.col(target).isNotNull())
        .orderBy(F.desc("n"), target)
    )


def class_filter_report(df: DataFrame, target: str, min_samples: int) -> DataFrame:
    """One row: kept rows, kept classes, dropped rows. One pass over the class counts."""
    n, kept = F.col("n"), (F.col("n") >= min_samples) & F.col(target).isNotNull()
    return class_counts(df, target).agg(
        F.coalesce(F.sum(F.when(kept, n)), F.lit(0)).alias("kept_rows"),
        F.count(F.when(kept, 1)).alias("kept_classes"),
        F.coalesce(F.sum(F.when(~kept, n)), F.lit(0)).alias("dropped_rows"),
    )


def split_by_rule(tickets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settled by a rule, left for the models)."""
    ruled = is_ruled_out(F.col("description"))
    return tickets.filter(ruled), tickets.filter(~ruled)


def unlabelled(tickets: DataFrame, omv: str = "omv") -> DataFrame:
    """Rows with a description and no intervention label yet."""
    return with_text(tickets).filter(F.trim(F.coalesce(F.col(omv), F.lit(""))) == "")


def with_text(tickets: DataFrame) -> DataFrame:
    """Rows with a non-blank description."""
    return tickets.filter(F.trim(F.coalesce(F.col("description"), F.lit(""))) != "")


def one_ticket(tickets: DataFrame, incident_id: int) -> DataFrame:
    return tickets.filter(F.col("incident_id") == incident_id)
