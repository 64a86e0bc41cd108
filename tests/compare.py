"""Run registered queries and their checking SQL side by side."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6f}" if value != int(value) or abs(value) > 1e15 else f"{int(value)}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str):
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        result = db.execute(sql)
        return rows_of([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, sf_dir: str, run, sql: str | None) -> tuple[int, str]:
    """(rows, what differs)."""
    columns, rows = spark_rows(run(spark, sf_dir))
    if sql is None:
        return len(rows), ""
    want_columns, want = oracle_rows(sf_dir, sql)
    if columns != want_columns:
        return len(rows), f"columns {columns} != {want_columns}"
    if rows != want:
        extra = [r for r in rows if r not in set(want)][:2]
        lost = [r for r in want if r not in set(rows)][:2]
        clip = lambda rs: [tuple(v[:80] for v in r) for r in rs]
        return len(rows), f"{len(rows)} rows != {len(want)}; extra {clip(extra)} lost {clip(lost)}"
    return len(rows), ""


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            n, problem = difference(spark, sf, run, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        state = "ok " if not problem else "BAD"
        kind = "sql " if name in oracles else "rows"
        print(f"{state} {kind} {name:34s} {n:8d} {time.time() - start:6.1f}s {problem}", flush=True)
