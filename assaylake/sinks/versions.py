"""Tables that are replaced as a whole: a new version is written, checked, then published.

A reader resolves the newest published version, so a failed load leaves the old one in place. The
list of published versions is an append-only table; publishing adds one row to it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import geo
from assaylake.functions.text import checked_name, safe_id_text
from assaylake.sources.files import latest_complete_batch
from assaylake.sources.tables import archived_layer

_VERSIONS = "table string, version bigint, batch_id string, columns string, row_count bigint, location string, published_at timestamp"


class LoadRefused(ValueError):
    """A load that must not replace the table. The published version is unchanged."""


class VersionedTables:
    """Replaceable tables under one shared root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root
        self._log = os.path.join(root, "_published")

    def published(self) -> DataFrame:
        try:
            return self._spark.read.schema(_VERSIONS).parquet(self._log)
        except AnalysisException:
            return self._spark.createDataFrame([], _VERSIONS)

    def current(self, table: str):
        """The newest published version of a table, or None. One row reaches the driver."""
        return self.published().filter(F.col("table") == table).orderBy(F.col("version").desc()).limit(1).first()

    def read(self, table: str) -> DataFrame:
        row = self.current(table)
        if row is None:
            raise LoadRefused(f"table {table} has no published version")
        return self._spark.read.parquet(row["location"])

    def read_as_of(self, table: str, at) -> DataFrame:
        """The version that was current at a moment."""
        row = (self.published().filter((F.col("table") == table) & (F.col("published_at") <= F.lit(at)))
               .orderBy(F.col("version").desc()).limit(1).first())
        if row is None:
            raise LoadRefused(f"table {table} had no version at {at}")
        return self._spark.read.parquet(row["location"])

    def replace(self, table: str, df: DataFrame, batch_id: str, evolve: bool = False) -> dict[str, Any]:
        return self.replace_all({checked_name(table): df}, batch_id, evolve)[table]

    def replace_all(self, frames: Mapping[str, DataFrame], batch_id: str, evolve: bool = False) -> dict[str, dict]:
        """Replace several tables together: all are written and checked before any is published.

        The rows that publish them go out in one append, so readers see all or none. Changed
        columns - names, order or types - are refused unless ``evolve``.
        """
        kinds = {t: ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema) for t, df in frames.items()}
        current = {t: self.current(t) for t in frames}
        for table, df in frames.items():
            old = current[table]
            if old is not None and not evolve and old["columns"] != kinds[table]:
                raise LoadRefused(f"the columns of {table} changed from {old['columns']} to {kinds[table]}")
        rows, done = [], {}
        for table, df in frames.items():
            version = (current[table]["version"] if current[table] else 0) + 1
            location = os.path.join(self._root, table, f"v{version}-{uuid.uuid4().hex}")
            df.write.mode("error").parquet(location)
            count = self._spark.read.parquet(location).count()
            rows.append((table, version, batch_id, kinds[table], count, location))
            done[table] = {"table": table, "version": version, "rows": count, "batch_id": batch_id}
        entries = self._spark.createDataFrame(
            rows, "table string, version bigint, batch_id string, columns string, row_count bigint, location string")
        entries.coalesce(1).withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(self._log)
        return done

    def batches(self, table: str) -> DataFrame:
        """The newest batch of a table and all batches it ever held."""
        return self.published().filter(F.col("table") == table).agg(
            F.max_by("batch_id", "version").alias("latest_batch"),
            F.array_sort(F.collect_set("batch_id")).alias("batches"))


# --- layers ----------------------------------------------------------------------------------------

def load_layer(tables: VersionedTables, serving: DataFrame, vault: DataFrame, layer: str, batch_id: str) -> dict:
    """Replace a layer's serving table and vault rows together."""
    sealed = vault.select(F.lit(layer).alias("layer"), "record_id", "column_name", "ciphertext", "key_version",
                          F.lit(batch_id).alias("batch_id"))
    done = tables.replace_all({checked_name(layer): serving, f"{layer}_vault": sealed}, batch_id)
    return {"table": layer, "rows": done[layer]["rows"], "vault_rows": done[f"{layer}_vault"]["rows"],
            "batch_id": batch_id}


def serving_view(df: DataFrame, exposed: list[str], private: list[str], geometry: str | None = "geom") -> DataFrame:
    """Only the exposed columns. Columns with personal data cannot be exposed."""
    for name in exposed:
        checked_name(name)
    if clash := sorted(set(exposed) & set(private)):
        raise LoadRefused(f"columns with personal data cannot be exposed: {clash}")
    shape = [geometry] if geometry and geometry in df.columns else []
    return df.select(*exposed, *shape)


def archive_layer(df: DataFrame, root: str, layer: str, batch_id: str, name: str = "layer") -> str:
    """Archive a batch of a layer with the extent of every feature; writing it again replaces it.

    Extents are plain numbers inside a struct, so Parquet keeps their range per row group and a box
    filter skips files.
    """
    if "geom" in df.columns:
        df = df.withColumn("bbox", geo.bounds(F.col("geom")))
        df = df.repartitionByRange("bbox.xmin", "bbox.ymin").sortWithinPartitions("bbox.xmin", "bbox.ymin")
    path = os.path.join(root, name)
    stamped = df.withColumns({"layer": F.lit(layer), "batch": F.lit(safe_id_text(batch_id))})
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("layer", "batch").parquet(path))
    return path


def inside_box(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Archived features whose extent meets a box; the comparisons reach the Parquet reader."""
    xmin, ymin, xmax, ymax = box
    return df.filter((F.col("bbox.xmax") >= xmin) & (F.col("bbox.xmin") <= xmax)
                     & (F.col("bbox.ymax") >= ymin) & (F.col("bbox.ymin") <= ymax))


def archived_batches(spark: SparkSession, root: str) -> DataFrame:
    """``layer, batch, file_name, modified`` of the layer and vault archives."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(root)
    at = r"/(layer|vault)/layer=([^/]+)/batch=([^/]+)/"
    return files.select(
        F.regexp_extract("path", at, 2).alias("layer"), F.regexp_extract("path", at, 3).alias("batch"),
        F.regexp_extract("path", at, 1).alias("file_name"), F.col("modificationTime").alias("modified"),
    ).filter(F.col("batch") != "")


def rebuild_layer(tables: VersionedTables, spark: SparkSession, root: str, layer: str) -> dict:
    """Reload a layer and its vault from the newest batch that has both archives."""
    newest = latest_complete_batch(archived_batches(spark, root), ["layer", "vault"]).filter(
        F.col("layer") == layer).first()
    if newest is None:
        raise LoadRefused(f"no complete archive of {layer}")
    batch = newest["batch"]

    def read(name: str) -> DataFrame:
        return archived_layer(spark, os.path.join(root, name), layer, batch)

    return load_layer(tables, read("layer").drop("bbox"), read("vault"), layer, batch)
