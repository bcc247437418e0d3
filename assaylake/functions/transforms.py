"""Named transforms that column mappings may refer to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from assaylake.functions import text

Transform = Callable[[Column], Column]

# Transform names as they appear in mapping files.
DATE_US_TO_ISO = "parse_date(mm/dd/yyyy -> ISO 8601)"
CURRENCY_TO_FLOAT = "strip_currency_formatting -> float"

_TRANSFORMS: dict[str, Transform] = {
    DATE_US_TO_ISO: text.us_date_to_iso,
    CURRENCY_TO_FLOAT: text.currency_to_double,
}


def register_transform(name: str, build: Transform) -> None:
    """Add a transform: a function from Column to Column, so it stays in the plan."""
    _TRANSFORMS[name] = build


def transformed(column: Column, name: str | None) -> Column:
    """Apply a named transform; no name leaves the column as it is."""
    if not name:
        return column
    if name not in _TRANSFORMS:
        raise KeyError(f"unknown transform {name!r}; known: {sorted(_TRANSFORMS)}")
    return _TRANSFORMS[name](column)
