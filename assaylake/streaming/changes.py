"""Change topics as streams: current state, counts per window, landing events, incremental pulls."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assaylake.operators.cdc import change_rows, without_deleted
from assaylake.operators.keys import latest_by
from assaylake.sources.records import parse_changes

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = "_epoch"
RUN = "_run"  # never looks like a number or a date, so it is read back as text


def file_changes(spark: SparkSession, folder: str, row: T.StructType | Sequence[str], files_per_batch: int = 1000) -> DataFrame:
    """A stream of change events from JSON-lines files as they land."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return parse_changes(raw, row)


def topic_changes(spark: SparkSession, servers: str, pattern: str, row: T.StructType | Sequence[str]) -> DataFrame:
    """A stream of every topic matching a pattern. Needs the Kafka connector on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribePattern", pattern).option("startingOffsets", "earliest").load())
    return parse_changes(raw.select(F.col("value").cast("string").alias("value")), row)


def for_table(events: DataFrame, table: str) -> DataFrame:
    """The events of one source table out of a stream of many."""
    return events.filter(F.coalesce(F.col("source.table"), F.col("table")) == table)


_PUBLISHED = f"version bigint, location string, {RUN} string, upto bigint"


class StateTable:
    """Current state of a change stream, as a log of changed keys with snapshots.

    Every micro batch writes one row per key it touched into a partition of its run and epoch, so the cost of a
    batch follows its size, a retried batch replaces itself, and a stream that starts over with a new checkpoint
    leaves what older runs wrote. Deletes stay in the log as rows: a late older event cannot bring a key back.
    ``compact`` folds the log into a snapshot; from then on reads skip the partitions it covers.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ties: Sequence[str] = ()) -> None:
        self._spark = spark
        self._root = root
        self._log = os.path.join(root, "log")
        self._published = os.path.join(root, "published")
        self._keys = list(keys)
        self._ties = list(ties)

    def newest(self, rows: DataFrame) -> DataFrame:
        return latest_by(rows, self._keys, ["_operation_timestamp"], self._ties)

    def absorb(self, batch: DataFrame, epoch: int, run: str = "run-0") -> None:
        """Write one micro batch, reduced to its newest event per key. Safe to repeat."""
        (self.newest(batch).withColumns({RUN: F.lit(run), EPOCH: F.lit(epoch)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(RUN, EPOCH).parquet(self._log))

    def _snapshot(self) -> tuple[int, str, dict[str, int]] | None:
        """Number and place of the newest snapshot, and up to which epoch of each run it reaches."""
        try:
            published = self._spark.read.schema(_PUBLISHED).parquet(self._published)
        except AnalysisException:
            return None
        rows = published.filter(F.col("version") == published.agg(F.max("version")).scalar()).collect()  # a row for each run
        return (rows[0]["version"], rows[0]["location"], {r[RUN]: r["upto"] for r in rows}) if rows else None

    def with_deletes(self) -> DataFrame:
        """The newest event of every key, deletes included."""
        log = self._spark.read.parquet(self._log)
        snapshot = self._snapshot()
        if snapshot is None:
            return self.newest(log.drop(RUN, EPOCH))
        _, location, reach = snapshot
        for run, upto in reach.items():
            log = log.filter((F.col(RUN) != run) | (F.col(EPOCH) > upto))
        return self.newest(log.drop(RUN, EPOCH).unionByName(self._spark.read.parquet(location)))

    def current(self) -> DataFrame:
        return without_deleted(self.with_deletes())

    def compact(self) -> int | None:
        """Fold the log into a snapshot and publish it; returns its number. The log stays."""
        reach = {r[RUN]: r["upto"] for r in self._spark.read.parquet(self._log).groupBy(RUN).agg(F.max(EPOCH).alias("upto")).collect()}
        last = self._snapshot()
        if not reach or (last and last[2] == reach):
            return last[0] if last else None
        version = last[0] + 1 if last else 1
        location = os.path.join(self._root, "snapshots", f"v{version}-{uuid.uuid4().hex}")
        self.with_deletes().write.parquet(location)
        rows = [(version, location, run, upto) for run, upto in reach.items()]
        self._spark.createDataFrame(rows, _PUBLISHED).coalesce(1).write.mode("append").parquet(self._published)
        return version


def run_state(events: DataFrame, columns: Sequence[str], state: StateTable, checkpoint: str,
              every: str | None = None) -> StreamingQuery:
    """Keep a state table up to date. Without ``every`` it takes what is there and stops.

    Epochs are kept apart by run; a batch that is repeated after a restart is there twice, which changes no state.
    """
    run = f"run-{uuid.uuid4().hex}"
    rows = change_rows(events, columns)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, epoch: state.absorb(batch, epoch, run))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def windowed_counts(events: DataFrame, at: str, kinds: str, wanted: Sequence[str] | None = None,
                    window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events per window and kind. The watermark bounds the state and drops what comes too late."""
    rows = events.filter(F.col(kinds).isin(list(wanted))) if wanted else events
    timed = rows.withWatermark(at, late) if rows.isStreaming else rows
    return timed.groupBy(F.window(at, window).alias("w"), kinds).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), kinds, "n")


WINDOW_COUNTS = "window_start timestamp, kind string, n bigint"


def run_window_counts(events: DataFrame, at: str, kinds: str, path: str, checkpoint: str, wanted: Sequence[str] | None = None,
                      window: str = "5 minutes", every: str | None = None) -> StreamingQuery:
    """Collect events in batches (``every``, such as ``300 seconds``) and write what each adds to its windows.

    A batch writes one row per window and kind it touched, under a partition of its run and epoch, so a retried batch replaces itself.
    Every window can be read at once with ``window_totals``, the last ones too, and events of any age amend theirs; nothing is
    held between batches. Without ``every`` it takes what is there and stops.
    """
    run = f"run-{uuid.uuid4().hex}"
    rows = events.filter(F.col(kinds).isin(list(wanted))) if wanted else events

    def add(batch: DataFrame, epoch: int) -> None:
        counts = batch.where(F.col(at).isNotNull()).groupBy(F.window(at, window).alias("w"), F.col(kinds).cast("string").alias("kind")).agg(F.count("*").alias("n"))
        counts.select(F.col("w.start").alias("window_start"), "kind", "n", F.lit(run).alias(RUN), F.lit(epoch).alias(EPOCH)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(RUN, EPOCH).parquet(path)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def window_totals(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, kind, n): all counts written so far."""
    return spark.read.schema(f"{WINDOW_COUNTS}, {RUN} string, {EPOCH} bigint").parquet(path).groupBy("window_start", "kind").agg(F.sum("n").alias("n"))


def run_append(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append finished rows of a stream to a Parquet table."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def landing_stream(batches: DataFrame, key: str) -> DataFrame:
    """Key and JSON value of each landed row, for a topic or folder sink."""
    return batches.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*batches.columns)).alias("value"))


def since_cursor(df: DataFrame, cursor: str, state: DataFrame) -> DataFrame:
    """Rows past the highest cursor value already held; all rows for an empty state."""
    mark = state.agg(F.max(cursor)).scalar()
    return df.filter(F.col(cursor).isNotNull() & (mark.isNull() | (F.col(cursor) > mark)))
