"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "assaylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is designed for. A caller's own session works too."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.showConsoleProgress": "false",
        # literals shaped like key material never reach explain output
        "spark.sql.redaction.string.regex": "(?i)(secret|hmac|enc)[_-]?key=\\S+",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under the shared folder the session names.

    Where ``spark.checkpoint.dir`` is unset a local session falls back to a temporary folder;
    a cluster session refuses, because other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="assaylake-")
    return os.path.join(base, "assaylake", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table under the shared folder and read it back, so that a lost executor costs no more than it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table's rows dealt out to all cores where it comes in few pieces; for work that is costly by the row.

    A small file is read by few tasks, however much work its rows are. Meant for plain reads: counting the pieces of a plan with
    shuffles would run them.
    """
    pieces = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(pieces) if df.rdd.getNumPartitions() < pieces else df
