"""The registered queries: name, Spark function, SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query. Without SQL its rows are checked by the tests instead."""
    def add(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: Column | str) -> Column:
    """A date as ISO text, the same in every engine."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def stamp(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def joined(c: Column | str) -> Column:
    """An array as text."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


def sql_text(*columns: str) -> str:
    """The text of a row as the content digest takes it, in SQL."""
    return " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in columns)


def sql_digest(text: str) -> str:
    """The content digest of rows with the given text, in SQL."""
    sums = ", ".join(f"sum(('0x' || substr(sha256({text}), {8 * i + 1}, 8))::bigint)::varchar" for i in range(8))
    return f"sha256(concat_ws(',', count(*)::varchar, {sums}))"
