"""Session settings, shared scratch space, and materialised tables."""

from __future__ import annotations

import math
import re
import sys
import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Work per shuffle partition that fits easily in one executor core's memory.
BYTES_PER_PARTITION = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for `input_bytes` of text, at least one per core."""
    return max(cores, math.ceil(input_bytes / BYTES_PER_PARTITION))


def build_session(
    app: str = "ticketloom", master: str | None = None, input_bytes: int = 0, cores: int = 8
) -> SparkSession:
    """A session with the settings the jobs are designed for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
        .config("spark.sql.files.maxPartitionBytes", str(BYTES_PER_PARTITION))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local master."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ticketloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table and read it back.

    Cuts the lineage, and a lost executor costs a file read, not the whole plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*plans: Callable[[], object]) -> list:
    """The results of plans that do not need each other; Spark deals out the tasks of all their jobs."""
    with ThreadPool(len(plans)) as pool:
        return pool.map(lambda plan: plan(), plans, chunksize=1)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; one in fewer pieces than cores is spread before costly text work.

    A large table has many pieces and is read as it is.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    pieces = df.rdd.getNumPartitions()  # plans the scan, reads nothing
    return df if pieces >= cores else df.repartition(cores)


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 8 * 1024 * 1024) -> None:
    """Limit what one Arrow batch holds, so that long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def ship_with_tasks(module: str) -> None:
    """Send the functions of `module` with each task, so workers need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
