"""The run log: one wide row of metrics per training run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.constants import BASELINE_METRICS, RUN_LOG_COLUMNS

LOG_SCHEMA = (
    "timestamp timestamp, run_id string, pipeline string, model_type string, omv_acc double, "
    "omv_f1 double, svc_acc double, svc_f1 double, ori_acc double, ori_f1 double, comment string"
)
# --- Fixed values: log column prefix per target -------------------------------------
PREFIX = {"OMV": "omv", "SERVICE": "svc", "ORIGINE": "ori"}


def wide_metrics(metrics: DataFrame, *by: str) -> DataFrame:
    """(*by, omv_acc, omv_f1, ...) from long (*by, target, accuracy, f1_macro).

    A metric that is missing or zero counts as not measured (null).
    """

    def measured(name: str):
        return F.first(F.when(F.col(name) != 0, F.col(name)), ignorenulls=True)

    wide = (
        metrics.groupBy(*by)
        .pivot("target", list(PREFIX))
        .agg(measured("accuracy").alias("acc"), measured("f1_macro").alias("f1"))
    )
    return wide.select(
        *by, *[F.col(f"{t}_{m}").alias(f"{p}_{m}") for t, p in PREFIX.items() for m in ("acc", "f1")]
    )


@dataclass(frozen=True)
class Measured:
    """A target's scores in one run; `combined` has those of lookup and model together, if there are any."""

    target: str
    accuracy: float | None = None
    f1_macro: float | None = None
    combined: tuple[float | None, float | None] | None = None

    @property
    def scores(self) -> tuple[float | None, float | None]:
        return self.combined if self.combined is not None else (self.accuracy, self.f1_macro)


def log_run(
    spark: SparkSession, path: str, results: list[Measured], pipeline: str, model_type: str,
    comment: str = "", now: datetime | None = None, key: str | None = None,
) -> None:
    """Append one run to the log, which is created when new.

    A run's row has a folder of its own, named by `key` (by default a new one). Writing a run again
    under its key replaces it, so a retry leaves one row, and one that was cut short leaves none.
    """
    now = now or datetime.now()
    metrics = spark.createDataFrame(
        [(r.target, *r.scores) for r in results], "target string, accuracy double, f1_macro double"
    ).withColumn("run_id", F.lit(now.strftime("%Y%m%d_%H%M%S")))
    row = wide_metrics(metrics, "run_id").withColumns({
        "timestamp": F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"),
        "pipeline": F.lit(pipeline), "model_type": F.lit(model_type), "comment": F.lit(comment),
    })
    folder = f"{path}/{key or uuid.uuid4().hex}"
    row.select(*RUN_LOG_COLUMNS).coalesce(1).write.mode("overwrite").parquet(folder)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs; folders and files of one log may be of any number."""
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def compact_log(spark: SparkSession, path: str, into: str) -> None:
    """Write all runs of a log as one file into a new log, which then takes new runs like any other."""
    read_log(spark, path).coalesce(1).write.mode("errorifexists").parquet(f"{into}/{uuid.uuid4().hex}")


def printable(log: DataFrame) -> DataFrame:
    """All text: four decimals, N/A where not measured."""
    numbers = [f"{p}_{m}" for p in PREFIX.values() for m in ("acc", "f1")]
    return log.withColumns(
        {
            n: F.when(F.col(n).isNull(), "N/A").otherwise(F.format_string("%.4f", F.col(n)))
            for n in numbers
        }
        | {"timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")}
    )


def against_baseline(metrics: DataFrame) -> DataFrame:
    """(target, f1_macro, baseline_f1, gain): signed three decimals, a dash if unmeasured."""
    spark = metrics.sparkSession
    baseline = spark.createDataFrame(
        [(t, m["f1_macro"]) for t, m in BASELINE_METRICS.items()],
        "target string, baseline_f1 double",
    )
    gain = F.round(F.col("f1_macro") - F.col("baseline_f1"), 3)
    text = F.concat(F.when(gain >= 0, "+").otherwise("-"), F.format_string("%.3f", F.abs(gain)))
    return F.broadcast(baseline).join(metrics.select("target", "f1_macro"), "target", "left").select(
        "target", "f1_macro", "baseline_f1",
        F.when(gain.isNull(), "—").otherwise(text).alias("gain"),
    )
