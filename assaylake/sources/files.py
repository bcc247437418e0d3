"""Folder scans: all values as text, every file kept, the file name on every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_OBJECT = "_source_object"


class NoInputFiles(FileNotFoundError):
    """A folder holds no file of the wanted pattern."""


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, modified, bytes`` of the files under a folder. File contents are not read."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(folder)
    )
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def file_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The listing with the SHA-256 of each file's bytes."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(folder)
    )
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"),
                        F.sha2("content", 256).alias("sha256"))


def newest_file(listing: DataFrame) -> DataFrame:
    """The newest file of a listing and how many others there were. One aggregate, no sort."""
    return listing.agg(
        F.max_by("path", F.struct("modified", "path")).alias("path"),
        F.max("modified").alias("modified"),
        (F.count("*") - 1).alias("other_candidates"),
    )


def candidates(listing: DataFrame) -> DataFrame:
    """All files of a listing, the newest first, ties by path; ``rank`` 1 is what ``newest_file`` takes."""
    newest_first = Window.orderBy(F.desc("modified"), F.desc("path"))  # a listing is one row a file, not data
    return listing.withColumn("rank", F.row_number().over(newest_first).cast("bigint")).orderBy("rank")


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_folder(
    spark: SparkSession, folder: str, columns: Sequence[str], pattern: str = "*.csv", multiline: bool = False,
) -> DataFrame:
    """All files matching any of the comma-separated patterns, as text.

    Only the empty string is null; ``NA`` stays text and blanks are kept. The declared columns are
    checked against each file's header. ``multiline`` is for quoted line breaks; it gives up
    splitting a file between tasks.
    """
    patterns = [p.strip() for p in pattern.split(",") if p.strip()]
    glob = patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}"
    reader = (
        spark.read.schema(_text_schema(columns)).option("header", True).option("nullValue", "")
        .option("emptyValue", "").option("escape", '"').option("multiLine", multiline)
        .option("enforceSchema", False).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True).option("mode", "FAILFAST")
    )
    df = reader.csv(folder)
    if not df.inputFiles():
        raise NoInputFiles(f"no file matches {pattern!r} in {folder}")
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_OBJECT)).select(
        *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns], SOURCE_OBJECT)


def without_trimmed_rows(df: DataFrame, line: str, skip_pattern: str) -> DataFrame:
    """Drop header and footer lines by what they look like, which needs no row order."""
    return df.filter(~F.coalesce(F.col(line).rlike(skip_pattern), F.lit(False)))


def latest_per_source(manifest: DataFrame, source: str = "source_id", modified: str = "modified",
                      path: str = "path") -> DataFrame:
    """The newest staged file of every source; quarantined copies do not count."""
    kept = manifest.filter(~F.coalesce(F.col(path).rlike("(^|/)quarantine/"), F.lit(False)))
    return kept.groupBy(source).agg(
        F.max_by(path, F.struct(modified, path)).alias(path), F.max(modified).alias(modified))


def latest_complete_batch(
    listing: DataFrame, required: Sequence[str], layer: str = "layer", batch: str = "batch",
    name: str = "file_name", modified: str = "modified",
) -> DataFrame:
    """Per layer the newest batch that has every required file, by the age of the first of them."""
    present = [F.max(F.when(F.col(name) == f, 1).otherwise(0)).alias(f"_has_{i}") for i, f in enumerate(required)]
    per_batch = listing.groupBy(layer, batch).agg(
        F.max(F.when(F.col(name) == required[0], F.col(modified))).alias("_at"), *present)
    complete = reduce(lambda a, b: a & b, [F.col(f"_has_{i}") == 1 for i in range(len(required))])
    return per_batch.filter(complete).groupBy(layer).agg(
        F.max_by(batch, F.struct("_at", batch)).alias(batch), F.max("_at").alias(modified))
