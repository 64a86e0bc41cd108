"""Small helpers that the operators of this package share."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One Arrow batch holds at most this much, so long texts do not pile up in a Python worker.
BATCH_ROWS = 2000
BATCH_BYTES = 8 * 1024 * 1024


def bounded_batches(spark: SparkSession) -> None:
    """Limit what one Arrow batch holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def utf8(column: str) -> Column:
    """The text's bytes as they are; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(name).to_pylist() for name in names]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches sorted by `key` so that no key is cut between two tables.

    A table holds about one batch, or the rows of one key where those are more; callers bound the
    rows of a key.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[-1].as_py()
        if held and held[-1].column(key)[-1].as_py() == last and keys[0].as_py() == last:
            held.append(batch)
            continue
        values = keys.to_numpy(zero_copy_only=False)
        cut = int((values != last).nonzero()[0][-1]) + 1 if (values != last).any() else 0
        if cut or held:
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            else:
                yield pa.Table.from_batches(held)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of `value` with the code of its class, so that workers need no installed package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(shared: Broadcast):
    """The value of `shipped`, made once in a Python worker and kept with the broadcast."""
    if not hasattr(shared, "unpacked"):
        shared.unpacked = pickle.loads(shared.value)
    return shared.unpacked


def partitions_for(spark: SparkSession) -> int:
    """Partitions of an explicit shuffle: as many as the session gives its own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Hash slots of the filter below; it bounds what is broadcast, whatever the number of keys.
SLOTS = 1 << 20


def touched(rows: DataFrame, keys: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a key of `keys`, and rows that surely have none, told apart without a shuffle."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(SLOTS))
    name = fresh_name(rows, "slot")
    slots = F.broadcast(keys.select(slot.alias(name)).distinct())
    return rows.join(slots, slot == F.col(name), "left_semi"), rows.join(slots, slot == F.col(name), "left_anti")
