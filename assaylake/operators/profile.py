"""Column profiles, completeness and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _measure(c: Column, kind: T.DataType) -> Column:
    return F.avg(c.cast("double")) if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, null share, distinct values, least, greatest, mean.

    All columns share one aggregate. Distinct counts are sketches unless ``exact``.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns or df.columns)
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count("*").alias("_rows")]
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        aggs += [F.count(c).alias(f"_n{i}"), distinct(c).alias(f"_d{i}"), F.min(c).cast("string").alias(f"_lo{i}"),
                 F.max(c).cast("string").alias(f"_hi{i}"), _measure(c, kinds[name]).alias(f"_m{i}")]
    wide = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.round((F.col("_rows") - F.col(f"_n{i}")) * 100.0 / F.nullif(F.col("_rows"), F.lit(0)), 2).alias("null_pct"),
            F.col(f"_d{i}").alias("distinct_count"), F.col(f"_lo{i}").alias("min_value"),
            F.col(f"_hi{i}").alias("max_value"), F.col(f"_m{i}").alias("mean_value"))
        for i, name in enumerate(columns)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("p")).select("p.*")


def completeness(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Share of filled values per column against a threshold."""
    entries = [
        F.struct(F.lit(c).alias("column"), (F.count(c) / F.nullif(F.count("*"), F.lit(0))).alias("share"),
                 (F.coalesce(F.count(c) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)) >= t).alias("complete"))
        for c, t in thresholds.items()
    ]
    return df.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def headline(df: DataFrame, stamp: str, now: Column, failures: str | None = None) -> DataFrame:
    """One row: mean share of filled values, age of the newest row in hours, quality index."""
    names = [c for c in df.columns if c != failures]
    filled = sum((F.count(F.col(f"`{c}`")) for c in names[1:]), F.count(F.col(f"`{names[0]}`")))
    quality = (F.round(F.avg(F.when(F.size(failures) > 0, 0.0).otherwise(1.0)) * 100, 1) if failures
               else F.lit(None).cast("double"))
    hours = F.timestamp_diff("HOUR", F.max(stamp), now)
    return df.agg(
        F.round(filled * 100.0 / F.nullif(F.count("*") * len(names), F.lit(0)), 2).alias("completeness_pct"),
        hours.alias("age_hours"), quality.alias("validation_score"))


def drift(before: DataFrame, after: DataFrame, null_pct: float = 5.0, duplicate_growth: float = 1.5) -> DataFrame:
    """Alerts from two profiles: more nulls than allowed, repeated values grown beyond a factor, or a column that one lacks."""
    def side(p: DataFrame, tag: str) -> DataFrame:
        repeated = F.col("row_count") - F.col("null_count") - F.col("distinct_count")
        return p.select("column", F.col("null_pct").alias(f"null_{tag}"), repeated.alias(f"dup_{tag}"))

    both = side(before, "before").join(side(after, "after"), "column", "full")
    alerts = F.array_compact(F.array(
        F.when(F.col("dup_after").isNull(), F.lit("column_removed")), F.when(F.col("dup_before").isNull(), F.lit("column_added")),
        F.when((F.col("null_after") > null_pct) & (F.col("null_after") > F.col("null_before")), F.lit("high_null_rate")),
        F.when(F.col("dup_after") > F.col("dup_before") * duplicate_growth, F.lit("duplicate_increase"))))
    return both.select("*", F.explode(alerts).alias("alert"))


def new_values(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Values of a column that were not there before."""
    seen = before.select(column).distinct()
    return after.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("row_count")).join(
        seen, column, "left_anti")
