"""The catalogue of registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# Written tables and trained models of this session, by scale and purpose, so that
# later queries read them instead of making them again.
_KEPT: dict[tuple, object] = {}


def kept(spark: SparkSession, sf: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the SQL that gives the same rows if there is one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
