"""Scalar text and value functions. All are Column expressions; none runs Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "[REDACTED]"

_NAME = re.compile(r"[a-z][a-z0-9_]{0,40}")


def is_blank(c: Column) -> Column:
    """True where the value is null or only white space."""
    return F.coalesce(~c.cast("string").rlike(r"\S"), F.lit(True))


def has_text(c: Column) -> Column:
    """True where the value holds at least one visible character."""
    return F.coalesce(c.cast("string").rlike(r"\S"), F.lit(False))


def stripped(c: Column) -> Column:
    """The text without white space at either end; null where nothing is left."""
    return F.nullif(F.regexp_replace(c, r"^\s+|\s+$", ""), F.lit(""))


def empty_to_null(c: Column) -> Column:
    """Only the empty string is null; ``NA`` and blanks stay text."""
    return F.nullif(c, F.lit(""))


def us_date_to_iso(c: Column) -> Column:
    """``M/D/YYYY`` text as ISO text. Anything unreadable passes through trimmed."""
    text = stripped(c)
    turned = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2")
    shaped = F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), turned)
    return F.coalesce(shaped.try_cast("date").cast("string"), text)


def currency_to_double(c: Column, parentheses_negative: bool = False) -> Column:
    """The number inside currency text. Unreadable text is null and is left to validation."""
    digits = F.nullif(F.regexp_replace(c, r"[^0-9.\-]", ""), F.lit(""))
    number = digits.try_cast("double")
    if parentheses_negative:
        number = F.when(c.rlike(r"^\s*\(.*\)\s*$"), -number).otherwise(number)
    return number


def epoch_days_to_date(c: Column) -> Column:
    """Days since 1970-01-01, or an ISO date, as a date."""
    text = c.cast("string")
    days = F.when(text.rlike(r"^-?\d+$"), text).try_cast("int")
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text).try_cast("date")
    return F.coalesce(F.date_add(F.lit("1970-01-01").cast("date"), days), iso)


def iso_to_date(c: Column) -> Column:
    """ISO date text as a date; anything else is null."""
    text = c.cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date")


def iso_to_timestamp(c: Column) -> Column:
    """ISO-8601 text as a timestamp without zone. The offset is dropped, not applied."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), c).try_cast("timestamp_ntz")


def quarter_start(c: Column) -> Column:
    """First day of the quarter."""
    return F.date_trunc("quarter", c).cast("date")


def quarter_label(c: Column) -> Column:
    """``2026-Q3``."""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole * 100``, null where the whole is zero."""
    return F.round(part / F.nullif(whole, F.lit(0).cast("decimal(18,2)")) * 100, digits)


def mask_text(c: Column) -> Column:
    """``j***@example.org`` for an e-mail address, ``J***`` for other text."""
    at = F.instr(c, "@")
    email = F.concat(
        F.when(at > 1, F.substring(c, 1, 1)).otherwise(F.lit("")),
        F.lit("***"),
        c.substr(at, F.length(c)),
    )
    return F.when(at > 0, email).otherwise(F.concat(F.substring(c, 1, 1), F.lit("***")))


def mask_digits_keep3(c: Column) -> Column:
    """Every digit but the last three becomes ``*``; with three or fewer all do."""
    digits = F.length(F.regexp_replace(c, r"[^0-9]", ""))
    keep_three = F.regexp_replace(c, r"[0-9](?=(?:[^0-9]*[0-9]){3})", "*")
    return F.when(digits <= 3, F.regexp_replace(c, r"[0-9]", "*")).otherwise(keep_three)


def safe_id(c: Column) -> Column:
    """Run ids as path-safe text."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._=-]", "_")


def safe_id_text(value: str) -> str:
    """Driver-side twin of :func:`safe_id`."""
    return re.sub(r"[^A-Za-z0-9._=-]", "_", value)


def slug(c: Column) -> Column:
    """Owner and tag names in the form the catalog uses."""
    return F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))


def checked_name(name: str) -> str:
    """A name that may be used in a path or as a table name."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} is not a safe name: lowercase letters, digits, underscores")
    return name


def content_sha256(c: Column, prefix: int | None = None) -> Column:
    """SHA-256 of content in hex, or its first characters."""
    digest = F.sha2(c.cast("binary"), 256)
    return F.substring(digest, 1, prefix) if prefix else digest


def json_or_default(c: Column, schema: str, default: Column) -> Column:
    """Parsed JSON text, or the default where it is null or broken."""
    return F.coalesce(F.from_json(c, schema), default)


def row_digest(*columns: Column) -> Column:
    """Order-free digest of a set of rows. A sum, so that equal rows do not cancel out."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def row_text(*columns: Column) -> Column:
    """Columns as one text that tells apart where each ends; ``-`` stands for null."""
    parts = [F.when(c.isNull(), "-").otherwise(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.concat(*parts)


def content_digest(text: Column) -> Column:
    """SHA-256 over a set of rows, whatever their order and partitioning.

    The digests of the rows are added up in eight parts of 32 bits, which combines within tasks, and the sums and the number of
    rows are hashed. Repeated rows count as often as they stand.
    """
    row = F.sha2(text, 256)
    sums = [F.coalesce(F.sum(F.conv(F.substring(row, 8 * i + 1, 8), 16, 10).cast("bigint").cast("decimal(38,0)")), F.lit(0)).cast("string") for i in range(8)]
    return F.sha2(F.concat_ws(",", F.count("*").cast("string"), *sums), 256)
