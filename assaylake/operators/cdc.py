"""Change events to current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.contract import Contract, Source
from assaylake.operators.canonical import CDC_COLUMNS, canonicalized
from assaylake.operators.keys import latest_by

# Operation codes.
OPERATIONS = ("c", "u", "d", "r", "insert", "update", "delete", "read")
DELETES = ("d", "delete")


def operation(op: Column, alternative: Column | None = None) -> Column:
    """The operation code; an event without one is an update."""
    parts = [op] + ([alternative] if alternative is not None else [])
    return F.coalesce(*parts, F.lit("u"))


def checked_operation(code: Column) -> Column:
    """The code, or a failed query where it is not known."""
    failure = F.raise_error(F.concat(F.lit("unsupported change operation: "), code))
    return F.when(code.isin(*OPERATIONS), code).otherwise(failure.cast("string"))


def change_rows(events: DataFrame, columns: Sequence[str], on_unknown: str = "fail") -> DataFrame:
    """The row image of each event with its operation, table and time.

    The image is ``after``, else ``before`` (deletes), else ``data``, else the event's own columns.
    ``on_unknown='keep'`` leaves unknown operations in, for a quarantine split.
    """
    have = set(events.columns)
    images = [F.col(name) for name in ("after", "before", "data") if name in have]
    bare = [F.col(c) if c in have else F.lit(None) for c in columns]

    def value(name: str, fallback: Column) -> Column:
        out = fallback.cast("string")
        for image in reversed(images):
            out = F.when(image.isNotNull(), image[name].cast("string")).otherwise(out)
        return out

    code = operation(F.col("op") if "op" in have else F.lit(None).cast("string"),
                     F.col("operation") if "operation" in have else None)
    tables = [F.col("source.table")] if "source" in have else []
    tables += [F.col("table")] if "table" in have else []
    stamps = [F.col(c) for c in ("ts_ms", "timestamp") if c in have]
    return events.select(
        *[value(c, b).alias(c) for c, b in zip(columns, bare)],
        (checked_operation(code) if on_unknown == "fail" else code).alias("_cdc_operation"),
        (F.coalesce(*tables) if tables else F.lit(None).cast("string")).alias("_source_table"),
        (F.coalesce(*stamps) if stamps else F.lit(None).cast("bigint")).alias("_operation_timestamp"),
    )


def latest_events(rows: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """The newest event per key. Events without a time lose."""
    return latest_by(rows, keys, ["_operation_timestamp"], ties)


def without_deleted(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("_cdc_operation").isin(*DELETES))


def current_state(rows: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Rows that exist now: the newest event per key, unless it is a delete."""
    return without_deleted(latest_events(rows, keys, ties))


def canonical_changes(
    events: DataFrame, contract: Contract, source: Source, precedence: str = "source_first",
) -> DataFrame:
    """The current state of a change channel in canonical form, with its change columns."""
    raw_names = [a.raw for a in source.aliases] or contract.names
    rows = change_rows(events, raw_names)
    df = canonicalized(rows, contract, source, CDC_COLUMNS, precedence)
    return current_state(df, contract.unique_fields) if contract.unique_fields else without_deleted(df)
