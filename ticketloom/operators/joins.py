"""Joins against dimensions whose size is checked, and the requester lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.constants import ALL_SERVICES, SOURCE_DEFAULT, SOURCE_LOOKUP, UNKNOWN
from ticketloom.functions.text import strip_accents
from ticketloom.session import materialise

# A dimension of at most this many short rows is broadcast.
BROADCAST_ROWS = 200_000
# Copies of a larger dimension, so that one hot key spreads over as many tasks.
SALTS = 32


def is_small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if `dim` has at most `rows` rows; reads no more than that."""
    return dim.limit(rows + 1).count() <= rows


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str,
    spread: Column,
    small: bool | None = None,
) -> DataFrame:
    """Join `fact` with a deduplicated dimension.

    A dimension of checked size is broadcast. A larger one is copied `SALTS`
    times and joined on key and salt, with the salt taken from `spread` (a
    row-unique expression), so that a hot or null key is shared by many tasks.
    The copies are never broadcast: Spark takes them to be as small as one copy is.
    """
    if is_small(dim) if small is None else small:
        return fact.join(F.broadcast(dim), on, how)
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = dim.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    )
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


# Keys that the sketch follows, and of these the most frequent ones that are broadcast.
TRACKED_KEYS, HEAVY_KEYS = 10_000, 1_000


def heavy_keys(fact: DataFrame, key: str) -> DataFrame:
    """(key): at most HEAVY_KEYS of the most frequent keys, found by a frequent-items sketch in one
    pass. Which keys these are changes how rows travel, never the result."""
    sketch = fact.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED_KEYS})").alias("top"))
    return sketch.select(F.explode("top.item").alias(key))


def heavy_hitter_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join of `fact` with a dimension of any size that has each key once.

    Rows with a frequent key meet their part of the dimension, of bounded size, where they are; the
    rest is joined by hash, in which no key is frequent any more. `fact` is read three times: give a
    written table.
    """
    heavy = materialise(heavy_keys(fact, key), "heavy-keys")
    keys = F.broadcast(heavy)
    frequent = F.broadcast(dim.join(keys, key, "left_semi"))
    rest = fact.join(keys, key, "left_anti").hint("shuffle_hash").join(dim.join(keys, key, "left_anti"), key)
    return fact.join(frequent, key).unionByName(rest)


def lookup_service(
    tickets: DataFrame, agents: DataFrame, small: bool | None = None
) -> DataFrame:
    """Add `service_deterministe`: the requester's service by exact, then accent-free name."""
    # Read three times: for its size and by both forms of the name.
    agents = materialise(agents.select("agent", "service"), "agents")
    if small is None:
        small = is_small(agents)
    known = F.when(F.col("demandeur") != UNKNOWN, F.col("demandeur"))
    spread = F.col("incident_id")
    exact = agents.select(
        F.col("agent").alias("_name"), F.col("service").alias("_by_name")
    )
    plain = agents.select(
        F.col("agent").alias("_plain"), F.col("service").alias("_by_plain")
    )
    joined = tickets.withColumn("_name", known)
    joined = dim_join(joined, exact, ["_name"], "left", spread, small)
    # Only rows the exact name did not settle need the second look-up.
    joined = joined.withColumn(
        "_plain", F.when(F.col("_by_name").isNull(), strip_accents(F.col("_name")))
    )
    joined = dim_join(joined, plain, ["_plain"], "left", spread, small)
    return joined.withColumn(
        "service_deterministe", F.coalesce("_by_name", "_by_plain")
    ).drop("_name", "_plain", "_by_name", "_by_plain")


def service_decision(service: Column) -> tuple[Column, Column]:
    """(service, source): the looked-up service, or all services."""
    found = F.coalesce(service, F.lit("")) != ""
    return (
        F.when(found, service).otherwise(F.lit(ALL_SERVICES)),
        F.when(found, F.lit(SOURCE_LOOKUP)).otherwise(F.lit(SOURCE_DEFAULT)),
    )
