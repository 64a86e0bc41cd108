"""The identity of a ticket: one unique value a row, made once or checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import materialise

ID = "incident_id"


def has_identity(df: DataFrame, column: str = ID) -> bool:
    return column.lower() in {c.lower() for c in df.columns}


def with_identity(df: DataFrame, column: str = ID) -> DataFrame:
    """`df` with a unique `column`: as it is if there is one, else numbered and written once.

    Ticket numbers are no identity: files may lack them, leave them blank or repeat them. The
    numbers made here follow the files and the rows in them and are stored with the rows, so a
    lost executor cannot change them.
    """
    if has_identity(df, column):
        return df
    return materialise(df.withColumn(column, F.monotonically_increasing_id()), "numbered")


def check_identity(df: DataFrame, column: str = ID) -> DataFrame:
    """`df` itself; raises if `column` is null or repeated anywhere. Only that column is shuffled."""
    bad = df.groupBy(column).agg(F.count("*").alias("rows")).where(F.col(column).isNull() | (F.col("rows") > 1))
    first = bad.orderBy(F.desc("rows")).first()
    if first is not None:
        raise ValueError(f"{column} must be unique and not null: {first[0]!r} has {first['rows']} rows")
    return df
