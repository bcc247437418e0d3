"""Run log, structured events and landing events. All are append-only rows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators.keys import latest_by

METRICS = ("rows_received", "rows_bronze", "rows_silver", "rows_gold", "hard_failures", "soft_warnings")
_RUN = ("execution_id string, dataset_name string, run_id string, batch_id string, status string, "
        + ", ".join(f"{m} bigint" for m in METRICS) + ", error_message string, logged_at timestamp")


def run_entry(spark: SparkSession, execution_id: str, dataset: str, run_id: str, batch_id: str | None, status: str,
              error: str | None = None, **metrics: int) -> DataFrame:
    """One row of the run log."""
    values = (execution_id, dataset, run_id, batch_id, status, *[int(metrics.get(m, 0)) for m in METRICS], error)
    schema = _RUN.rsplit(", logged_at", 1)[0]
    return spark.createDataFrame([values], schema).withColumn("logged_at", F.current_timestamp())


def append_run(entry: DataFrame, path: str) -> None:
    entry.coalesce(1).write.mode("append").parquet(path)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_RUN).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], _RUN)


def latest_runs(log: DataFrame, key: str = "execution_id", at: str = "logged_at", ties: tuple[str, ...] = ()) -> DataFrame:
    """The newest state of every run."""
    return latest_by(log, [key], [at], list(ties))


def event_lines(df: DataFrame, event: str, stamp: str | None = None) -> DataFrame:
    """Rows as JSON log lines with the event's name and time; keys in order of name."""
    at = F.col(stamp).cast("string") if stamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    columns = {**{c: F.col(c) for c in df.columns if c != stamp}, "event": F.lit(event), "timestamp": at}
    return df.select(F.to_json(F.struct(*[columns[c].alias(c) for c in sorted(columns)])).alias("value"))


def landing_events(manifests: DataFrame, run_id: str, landed_at: str) -> DataFrame:
    """Key and JSON value announcing landed batches, one event per dataset and batch."""
    body = F.struct("dataset", F.lit(run_id).alias("run_id"), "batch_id", "row_count", F.lit(landed_at).alias("landed_at"))
    per_batch = manifests.groupBy("dataset", "batch_id").agg(F.sum("row_count").alias("row_count"))
    return per_batch.select(F.col("dataset").alias("key"), F.to_json(body).alias("value"))


def publish(events: DataFrame, target: str, options: Mapping[str, Any] | None = None) -> None:
    """Write key and value rows to a Kafka topic (``kafka``) or a JSON folder (any path)."""
    if target == "kafka":
        events.write.format("kafka").options(**(options or {})).save()
    else:
        events.write.mode("append").json(target)
