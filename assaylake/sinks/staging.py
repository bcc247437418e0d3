"""Staged batches, their manifests, the staging table and quarantine."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.contract import Contract
from assaylake.functions.text import content_digest, row_digest, row_text, safe_id_text
from assaylake.operators.canonical import conformed
from assaylake.sources.files import SOURCE_OBJECT
from assaylake.sources.tables import STATUS

STAGING_COLUMNS = (STATUS, "_source_id", "_batch_id", "_ingested_at")


def new_batch_id(dataset: str) -> str:
    """``dataset-20260101T000000Z-1a2b3c4d``"""
    return f"{dataset}-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def now_text() -> str:
    return datetime.now(timezone.utc).isoformat()


def write_staged(df: DataFrame, root: str, dataset: str, source_id: str, agency: str, run_date: str,
                 batch_id: str, by_file: bool = False) -> str:
    """Write canonical rows under ``agency/dataset/run_date/batch``; a rerun replaces its own batch.

    Rows of all files stay together with their file's name; ``by_file`` gives each file a partition.
    """
    path = os.path.join(root, safe_id_text(agency), dataset, run_date, safe_id_text(batch_id), f"source={source_id}")
    writer = df.write.mode("overwrite")
    if by_file:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(SOURCE_OBJECT)
    writer.parquet(path)
    return path


def manifest(df: DataFrame, dataset: str, batch_id: str, agency: Column, source_id: Column,
             source_object: Column, path: Column) -> DataFrame:
    """One row per staged object: rows, bytes of their text, and digests of its contents that no order or partitioning changes."""
    data = [F.col(c) for c in df.columns if not c.startswith("_")]
    return df.groupBy(agency.alias("agency"), source_id.alias("source_id"),
                      source_object.alias("source_object")).agg(
        F.count("*").alias("row_count"), row_digest(*data).alias("checksum"), content_digest(row_text(*data)).alias("sha256"),
        F.sum(F.octet_length(row_text(*data))).alias("content_bytes")).select(
        F.lit(dataset).alias("dataset"), F.lit(batch_id).alias("batch_id"), "source_id", "agency", "source_object",
        "row_count", "checksum", "sha256", "content_bytes", path.alias("path"), F.lit(f"{dataset}-contract").alias("schema_ref"))


def batch_manifest(objects: DataFrame) -> DataFrame:
    """Rows, bytes and objects per batch and source, with the list of its objects and a digest over theirs."""
    listed = F.array_sort(F.collect_list(F.struct("source_object", "row_count", "sha256")))
    return objects.groupBy("dataset", "batch_id", "source_id").agg(
        F.sum("row_count").alias("row_count"), F.count("*").alias("object_count"), F.sum("checksum").alias("checksum"),
        F.sum("content_bytes").alias("content_bytes"), listed.alias("objects")).withColumn(
        "sha256", F.sha2(F.array_join(F.transform("objects", lambda o: o["sha256"]), ","), 256))


def layer_manifest(df: DataFrame, layer: str, run_id: str, source: DataFrame | None = None) -> DataFrame:
    """One row: features, the kinds of geometry found and the attribute columns of a layer, a digest and the bytes of its contents.

    With ``source``, the rows as they were read from files, also the number and the bytes of those files.
    """
    attributes = [c for c in df.columns if c != "geom"]
    text = row_text(*[F.col(c) for c in attributes], F.col("geom.kind"), F.to_json("geom.xs"), F.to_json("geom.ys"))
    out = df.agg(
        F.count("*").alias("feature_count"), F.array_sort(F.collect_set("geom.kind")).alias("geometry_types"),
        F.max("geom.srid").alias("srid"), content_digest(text).alias("sha256"), F.sum(F.octet_length(text)).alias("content_bytes"),
    ).withColumns({"layer": F.lit(layer), "run_id": F.lit(run_id),
                   "columns": F.array(*[F.lit(c) for c in attributes])})
    if source is None:
        return out
    files = source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).groupBy("file").agg(F.max("size").alias("size"))
    sums = files.agg(F.count("*").alias("source_files"), F.sum("size").alias("source_bytes"))
    return out.withColumns({c: sums.select(c).scalar() for c in ("source_files", "source_bytes")})


def stamped(df: DataFrame, contract: Contract, batch_id: str, source_id: str | Column, ingested_at: str) -> DataFrame:
    """Canonical rows as the staging table holds them: all text, with status, source, batch and time."""
    source = F.lit(source_id) if isinstance(source_id, str) else source_id
    ready = df.withColumns({STATUS: F.lit("pass"), "_source_id": source, "_batch_id": F.lit(batch_id),
                            "_ingested_at": F.lit(ingested_at)})
    return conformed(ready, [*contract.names, *STAGING_COLUMNS])


def append_staging(df: DataFrame, path: str) -> None:
    """Append a validated batch under its own partition, so that a retry does not add it twice."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(path)


def read_staging(spark, path: str) -> DataFrame:
    """The staging table, all text: a batch named ``007`` or ``2026-01-01`` keeps its name."""
    names = spark.read.parquet(path).columns
    return spark.read.schema(", ".join(f"`{n}` string" for n in names)).parquet(path)


def create_staging_table(spark, name: str, contract: Contract) -> None:
    """The staging table of a dataset in the session catalog, if it is not there yet."""
    columns = ", ".join(f"`{c}` STRING" for c in [*contract.names, *STAGING_COLUMNS])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def quarantined(df: DataFrame, root: str, dataset: str, run_id: str, reason: str, results: DataFrame) -> str:
    """Keep a failed batch with the reason and its rule results. Returns the folder."""
    folder = os.path.join(root, "quarantine", dataset, safe_id_text(run_id))
    df.write.mode("overwrite").parquet(os.path.join(folder, "rows"))
    failure_rows(results, dataset, run_id, reason).write.mode("overwrite").json(os.path.join(folder, "failure"))
    return folder


def failure_rows(results: DataFrame, dataset: str, run_id: str, reason: str) -> DataFrame:
    """One row per rule of a failed run, each with the rule's outcome as JSON."""
    return results.select(
        F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), F.lit(reason).alias("reason"),
        F.to_json(F.struct(*results.columns)).alias("rule_result"))


def expired(df: DataFrame, stamp: str, days: int, today: Column) -> DataFrame:
    """What a retention period leaves: rows younger than the given number of days."""
    return df.filter(F.col(stamp).cast("date") > F.date_sub(today, days))


LOG = "path string, day string, row_count bigint, removed_on date"


def retained(spark: SparkSession, tiers: Mapping[str, int], today: str, log: str, day: str = "day") -> DataFrame:
    """Remove the partitions of tables that are past their retention; returns a row for each that went, also kept in ``log``.

    ``tiers`` maps the folder of a table partitioned by ``day`` to the days it is kept, such as 14 for quarantine and 90 for the
    archive. Whole partitions go, one per day, so nothing is rewritten, and a second run finds nothing. The log is written first:
    a run that breaks off repeats its entry rather than losing it.
    """
    gone = []
    for path, days in tiers.items():
        try:
            table = spark.read.parquet(path)
        except AnalysisException:  # nothing was ever written, or all of it went
            continue
        if day not in table.columns:
            continue
        limit = F.date_sub(F.lit(today).cast("date"), days)
        old = table.where(F.col(day).cast("date") <= limit).groupBy(F.col(day).cast("string").alias("day")).agg(F.count("*").alias("row_count"))
        rows = old.select(F.lit(path).alias("path"), "day", "row_count", F.lit(today).cast("date").alias("removed_on")).collect()  # one per day
        if rows:
            spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(log)
        for row in rows:
            place = spark._jvm.org.apache.hadoop.fs.Path(path, f"{day}={row['day']}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        gone += rows
    return spark.createDataFrame(gone, LOG)


def lineage_rows(objects: DataFrame, status: str, seconds: float, run_date: str) -> DataFrame:
    """Ingestion lineage: source, rows, status and duration per batch."""
    return objects.groupBy("dataset", "batch_id", "source_id").agg(F.sum("row_count").alias("row_count")).select(
        "dataset", "batch_id", "source_id", "row_count", F.lit(status).alias("status"),
        F.lit(seconds).alias("ingestion_duration_seconds"), F.lit(run_date).cast("date").alias("run_date"))


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ordered by range of the keys, so that a reader skips files by their statistics."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """A Silver table under ``path``, bucketed and sorted by its keys: joins and latest-per-key on them need no shuffle of it."""
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, partition: str, keys: Sequence[str]) -> None:
    """A Gold table partitioned by one column and sorted inside its files.

    Rows are ranged by the keys too, so that a partition with a large share of the rows is written by
    several tasks and a small one by one.
    """
    ranged = df.repartitionByRange(partition, *keys).sortWithinPartitions(partition, *keys)
    ranged.write.mode("overwrite").partitionBy(partition).parquet(path)
