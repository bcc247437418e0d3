"""Raw columns onto the canonical schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.contract import Alias, Contract, Source
from assaylake.functions.text import epoch_days_to_date
from assaylake.functions.transforms import transformed

# Technical columns that may stand beside the canonical ones.
CDC_COLUMNS = ("_cdc_operation", "_source_table", "_operation_timestamp")
TECHNICAL_COLUMNS = (*CDC_COLUMNS, "_source_object", "_ingested_at", "_batch_id")
BATCH_CONSTANTS = ("agency", "region")
UNKNOWN = "unknown"


class ColumnMismatch(ValueError):
    """The columns of the data are not those of the contract."""


def aliased(raw: DataFrame, aliases: Sequence[Alias], keep: Sequence[str] = ()) -> DataFrame:
    """Renamed and transformed columns in one projection. Unmapped columns are dropped."""
    missing = [a.raw for a in aliases if a.raw not in raw.columns]
    if missing:
        raise ColumnMismatch(f"raw columns not found: {missing}")
    mapped = [transformed(F.col(f"`{a.raw}`"), a.transform).alias(a.canonical) for a in aliases]
    return raw.select(*mapped, *[c for c in keep if c in raw.columns])


def identity(raw: DataFrame, contract: Contract, keep: Sequence[str] = (), optional: Sequence[str] = ()) -> DataFrame:
    """The canonical columns in contract order."""
    missing = [n for n in contract.names if n not in raw.columns and n not in optional]
    if missing:
        raise ColumnMismatch(f"canonical columns not found: {missing}")
    names = [n for n in contract.names if n in raw.columns]
    return raw.select(*names, *[c for c in keep if c in raw.columns])


def with_constants(
    df: DataFrame, contract: Contract, constants: Mapping[str, str], precedence: str = "source_first",
) -> DataFrame:
    """Agency and region: the source's constant, the row's own value, or ``unknown``.

    ``row_first`` lets a row's own value win over the source's constant.
    """
    if precedence not in ("source_first", "row_first"):
        raise ValueError("precedence is 'source_first' or 'row_first'")
    columns = {}
    for name in BATCH_CONSTANTS:
        if name not in contract.names:
            continue
        constant = constants.get(name)
        own = F.col(name) if name in df.columns else None
        if constant and (own is None or precedence == "source_first"):
            columns[name] = F.lit(constant)
        elif own is not None and constant:
            columns[name] = F.coalesce(own, F.lit(constant))
        elif own is not None:
            columns[name] = own
        else:
            columns[name] = F.lit(UNKNOWN)
    return df.withColumns(columns) if columns else df


def decoded_dates(df: DataFrame, contract: Contract) -> DataFrame:
    """Day numbers in date fields as ISO text; text dates stay as they are."""
    columns = {}
    for f in contract.fields:
        if f.dtype == "date" and f.name in df.columns:
            text = F.col(f.name).cast("string")
            decoded = epoch_days_to_date(text).cast("string")
            columns[f.name] = F.when(text.rlike(r"^-?\d+$"), decoded).otherwise(text)
    return df.withColumns(columns) if columns else df


def canonicalized(
    raw: DataFrame, contract: Contract, source: Source, keep: Sequence[str] = (), precedence: str = "source_first",
) -> DataFrame:
    """Raw rows of one source as canonical rows."""
    if source.aliases:
        df = aliased(raw, source.aliases, keep)
    else:
        df = identity(raw, contract, keep, optional=[n for n in BATCH_CONSTANTS if source.constants.get(n)])
    df = decoded_dates(with_constants(df, contract, source.constants, precedence), contract)
    ordered = [n for n in contract.names if n in df.columns]
    return df.select(*ordered, *[c for c in df.columns if c not in ordered])


def check_columns(df: DataFrame, contract: Contract) -> None:
    """Refuse columns the contract does not know."""
    unexpected = sorted(set(df.columns) - set(contract.names) - set(TECHNICAL_COLUMNS))
    if unexpected:
        raise ColumnMismatch(f"unexpected columns for {contract.dataset}: {unexpected}")


def only_canonical(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(*[c for c in df.columns if c in contract.names])


def conformed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order, as text; absent ones are null, empty text is null."""
    return df.select(*[
        (F.nullif(F.col(n).cast("string"), F.lit("")) if n in df.columns else F.lit(None).cast("string")).alias(n)
        for n in names
    ])


def union_channels(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all channels aligned by column name; a channel's missing columns are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
