"""Records inside JSON payloads, connector logs and change topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_struct(schema: T.StructType | Sequence[str]) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType([T.StructField(c, T.StringType()) for c in schema])


def _nested(record: T.StructType, path: Sequence[str]) -> T.DataType:
    kind: T.DataType = T.ArrayType(record)
    for key in reversed(path):
        kind = T.StructType([T.StructField(key, kind)])
    return kind


BROKEN = "_broken"  # the text of what could not be read


def _read_or(on_broken: str, fine: Column, read: Column, text: Column, what: str) -> Column:
    """What was read. Broken input ends the query, or is null where it is kept."""
    if on_broken not in ("fail", "keep"):
        raise ValueError("on_broken is 'fail' or 'keep'")
    if on_broken == "keep":
        return F.when(fine, read)
    return F.when(fine, read).otherwise(F.raise_error(F.concat(F.lit(f"broken {what}: "), F.coalesce(F.left(text, F.lit(200)), F.lit("null")))))


def explode_records(
    payloads: DataFrame, schema: T.StructType | Sequence[str], field_path: Sequence[str] = ("data", "records"),
    text: str = "value", on_broken: str = "fail",
) -> DataFrame:
    """One row per record of each payload.

    The records are the array at ``field_path``, or the payload itself where it is a plain array. A payload that
    is cut off or holds no such list ends the query; with ``on_broken="keep"`` it becomes a row of its own, with
    its text in ``_broken``.
    """
    record = _as_struct(schema)
    at_path = F.from_json(F.col(text), _nested(record, field_path))
    for key in field_path:
        at_path = at_path[key]
    plain = F.from_json(F.col(text), T.ArrayType(record))
    is_list = F.ltrim(F.col(text)).startswith("[")
    records = F.when(is_list, plain).otherwise(at_path)
    safe = _read_or(on_broken, records.isNotNull(), records, F.col(text), "payload")
    if on_broken == "fail":
        return payloads.select(F.explode(safe).alias("_r")).select("_r.*")
    rows = payloads.select(F.explode(F.coalesce(safe, F.array(F.lit(None).cast(record)))).alias("_r"),
                           F.when(safe.isNull(), F.col(text)).alias(BROKEN))
    return rows.select("_r.*", BROKEN)


def read_json_payloads(
    spark: SparkSession, path: str, schema: T.StructType | Sequence[str],
    field_path: Sequence[str] = ("data", "records"), on_broken: str = "fail",
) -> DataFrame:
    """Landed API pages, one payload per file."""
    pages = spark.read.text(path, wholetext=True)
    return explode_records(pages, schema, field_path, on_broken=on_broken)


def protocol_records(log: DataFrame, schema: T.StructType | Sequence[str], text: str = "value") -> DataFrame:
    """The data of ``RECORD`` messages in a connector's log. Lines that are not JSON are skipped."""
    record = _as_struct(schema)
    message = T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("record", T.StructType([T.StructField("data", record)])),
    ])
    parsed = log.select(F.from_json(F.col(text), message).alias("_m"))
    return parsed.filter(F.col("_m.type") == "RECORD").select("_m.record.data.*")


def read_protocol_log(spark: SparkSession, path: str, schema: T.StructType | Sequence[str]) -> DataFrame:
    return protocol_records(spark.read.text(path), schema)


class NoRecords(ValueError):
    """A channel that must deliver something delivered nothing."""


def required(df: DataFrame, what: str) -> DataFrame:
    """The rows, unless there are none. Stops at the first row found."""
    if df.isEmpty():
        raise NoRecords(f"no records received from {what}")
    return df


def change_schema(row: T.StructType | Sequence[str]) -> T.StructType:
    """The change-event envelope, with the alternative key names some producers use."""
    image = _as_struct(row)
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("data", image),
        T.StructField("source", T.StructType([T.StructField("table", T.StringType())])),
        T.StructField("table", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        *image.fields,  # a bare row without an envelope
    ])


def parse_changes(raw: DataFrame, row: T.StructType | Sequence[str], text: str = "value", on_broken: str = "fail") -> DataFrame:
    """Change events from JSON text. Null values are delete tombstones and carry no event.

    An event that is no JSON object, or whose fields have other types than the envelope's, ends the query; with
    ``on_broken="keep"`` its fields are null and its text is in ``_broken``.
    """
    live = raw.filter(F.col(text).isNotNull() & (F.trim(F.col(text)) != ""))
    schema = change_schema(row)
    marked = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    live = live.select(F.from_json(F.col(text), marked, {"columnNameOfCorruptRecord": BROKEN}).alias("_e"), F.col(text).alias("_t"))
    # blank values are filtered out above, but Spark may look at them before it applies the filter
    blank = F.coalesce(F.trim("_t"), F.lit("")) == ""
    fine = blank | (F.col("_e").isNotNull() & F.col(f"_e.{BROKEN}").isNull())
    event = F.struct(*[F.col(f"_e.`{f.name}`").alias(f.name) for f in schema.fields])
    safe = live.select(_read_or(on_broken, fine, event, F.col("_t"), "change event").alias("_e"), F.when(~fine, F.col("_t")).alias(BROKEN))
    return safe.select("_e.*", BROKEN) if on_broken == "keep" else safe.select("_e.*")


def read_changes(spark: SparkSession, path: str, row: T.StructType | Sequence[str]) -> DataFrame:
    """A bounded set of change events from JSON lines."""
    return parse_changes(spark.read.text(path), row)


def read_changes_from_topic(
    spark: SparkSession, servers: str, pattern: str, row: T.StructType | Sequence[str],
) -> DataFrame:
    """A bounded read of every topic matching a pattern, from the earliest offset.

    Needs the Kafka connector on the class path.
    """
    raw = (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern).option("startingOffsets", "earliest")
        .option("endingOffsets", "latest").load()
    )
    return parse_changes(raw.select(F.col("value").cast("string").alias("value")), row)
