"""Questions people put to the finished tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.plans.medallion import PASS
from assaylake.session import stored


def violations(silver: DataFrame, digits: int = 2) -> DataFrame:
    """Rows per violation with their share of all rows. One scan: the total is summed over the
    counts, of which there are as many as kinds of flag."""
    per_flag = silver.groupBy("quality_flag").agg(F.count("*").alias("violation_count"))
    total = F.sum("violation_count").over(Window.partitionBy(F.lit(0)))
    shared = per_flag.withColumn("pct_of_total", F.round(F.col("violation_count") * 100.0 / total, digits))
    return shared.filter(F.col("quality_flag") != PASS)


def violating_rows(silver: DataFrame, top: int) -> DataFrame:
    """The first flagged rows by flag and agency."""
    return silver.filter(F.col("quality_flag") != PASS).orderBy("quality_flag", "agency", "project_id").limit(top)


def best_utilization(gold: DataFrame, since: str, top: int) -> DataFrame:
    """The highest utilization rates since a quarter."""
    ordered = gold.filter(F.col("quarter") >= F.lit(since).cast(gold.schema["quarter"].dataType)).orderBy(
        F.col("utilization_rate_pct").desc_nulls_last(), "agency", "program_area", "region_code", "quarter", "status")
    return ordered.limit(top)


def layer_trace(bronze: DataFrame, silver: DataFrame, gold: DataFrame, project_id: Column | str) -> DataFrame:
    """How often one project, and its agency, shows up in each layer and when it was last seen."""
    key = F.lit(project_id) if isinstance(project_id, str) else project_id
    agency = silver.filter(F.col("project_id") == key).agg(F.min("agency").alias("a")).scalar()
    empty = F.lit(None).cast("timestamp_ntz")
    parts = [
        bronze.filter(F.col("project_id") == key).agg(
            F.count("*").alias("row_count"), F.max("last_updated_at").alias("last_seen")),
        silver.filter(F.col("project_id") == key).agg(F.count("*").alias("row_count")).withColumn("last_seen", empty),
        gold.filter(F.col("agency") == agency).agg(F.count("*").alias("row_count")).withColumn("last_seen", empty),
    ]
    named = [p.select(F.lit(n).alias("layer"), "row_count", "last_seen") for n, p in zip(("Bronze", "Silver", "Gold"), parts)]
    return reduce(DataFrame.unionByName, named)


def with_registry(registry: DataFrame, facts: DataFrame, key: str = "dataset_name") -> DataFrame:
    """Registry columns beside facts aggregated per dataset."""
    return registry.join(facts, key)


def snapshot_counts(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("unique_keys"))


def run_statistics(runs: DataFrame, since: Column, dataset: str, status: str, at: str, seconds: str) -> DataFrame:
    """Runs and their mean duration per dataset and status since a moment."""
    return runs.filter(F.col(at) >= since).groupBy(dataset, status).agg(
        F.count("*").alias("job_count"), F.avg(seconds).alias("avg_duration"))


POINTS = (0.5, 0.95, 0.99)


RANGES = 64  # parts a span of values is cut into at a time
SPAN_VALUES = 1_000_000  # distinct values of a span that one task may put in order


def exact_percentiles(df: DataFrame, groups: Sequence[str], value: str, points: Sequence[float] = POINTS,
                      span_values: int = SPAN_VALUES) -> DataFrame:
    """Interpolated percentiles per group, exact, as columns ``q0, q1, ..``. Null values are left out.

    Distributed selection: equal values are counted first. While a span holds more than ``span_values`` distinct values, quantile
    sketches cut it into ranges, the values of each range are counted, and only ranges that hold a wanted position go on. The rows
    that are left are put in order span by span, so no task ever holds a group.
    """
    keys = [f"_g{i}" for i in range(len(groups))]
    counted = df.where(F.col(value).isNotNull()).groupBy(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    # a group that is null must still meet itself
    id_ = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])
    members = stored(counted.withColumns({"_id": F.struct(id_.alias("h"), *keys).cast("string"), "_span": F.lit(0).cast("decimal(38,0)")}), "values")
    total = stored(members.groupBy("_id", *keys).agg(F.sum("_c").alias("_n")), "totals")
    position = F.col("_n") - 1
    wanted = [(i, side, edge(position * F.lit(float(p)))) for i, p in enumerate(points) for side, edge in (("lo", F.floor), ("hi", F.ceil))]
    targets = total.select("_id", F.lit(0).cast("decimal(38,0)").alias("_span"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("point"), F.lit(side).alias("side"), at.cast("long").alias("at")) for i, side, at in wanted])).alias("_t")).select("_id", "_span", "_t.*")
    targets = stored(targets, "positions")
    part = ["_id", "_span"]
    while (members.groupBy(*part).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > span_values:
        cuts = members.groupBy(*part).agg(F.percentile_approx("_v", F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)]), F.lit(10 * RANGES)).alias("_cuts"))
        ranged = members.join(cuts, part).withColumn("_r", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
        ranged = stored(ranged, "ranges")
        counts = ranged.groupBy(*part, "_r").agg(F.sum("_c").alias("_held"))
        # at most RANGES rows for each span
        before = F.sum("_held").over(Window.partitionBy(*part).orderBy("_r")) - F.col("_held")
        inside = targets.join(counts.withColumn("_before", before), part).where((F.col("at") >= F.col("_before")) & (F.col("at") < F.col("_before") + F.col("_held")))
        finer = (F.col("_span") * RANGES + F.col("_r") + 1).cast("decimal(38,0)")
        targets = stored(inside.select("_id", finer.alias("_span"), "point", "side", (F.col("at") - F.col("_before")).alias("at")), "positions")
        members = stored(ranged.withColumn("_span", finer).drop("_r").join(targets.select(*part).distinct(), part, "left_semi"), "values")
    upto = F.sum("_c").over(Window.partitionBy(*part).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = members.withColumn("_upto", upto).join(targets, part).where((F.col("_upto") > F.col("at")) & (F.col("_upto") - F.col("_c") <= F.col("at")))
    found = placed.groupBy("_id").agg(*[F.max(F.when((F.col("point") == i) & (F.col("side") == side), F.col("_v"))).alias(f"_{side}{i}") for i, side, _ in wanted])

    def between(i: int, p: float) -> Column:
        share = position * F.lit(float(p)) - F.floor(position * F.lit(float(p)))
        return (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share).cast("double").alias(f"q{i}")

    return total.join(found, "_id").select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], *[between(i, p) for i, p in enumerate(points)])


def duration_metrics(
    runs: DataFrame, groups: list[str], seconds: str, succeeded: Column, sla_seconds: float, exact: bool = False,
) -> DataFrame:
    """p50, p95 and p99 of durations, the success rate and the share within the time promised.

    Percentiles are sketches unless ``exact``.
    """
    rates = [
        F.count("*").alias("runs"), F.avg(F.when(succeeded, 1.0).otherwise(0.0)).alias("success_rate"),
        F.avg(F.when(F.col(seconds) <= sla_seconds, 1.0).otherwise(0.0)).alias("sla_rate")]
    if exact:
        out = runs.groupBy(*groups).agg(*rates).join(exact_percentiles(runs, groups, seconds), groups, "left")
    else:
        sketch = F.percentile_approx(seconds, F.array(*[F.lit(p) for p in POINTS]))
        out = runs.groupBy(*groups).agg(*rates, sketch.alias("_q"))
        out = out.withColumns({f"q{i}": F.col("_q")[i] for i in range(len(POINTS))})
    return out.select(*groups, "runs", *[F.col(f"q{i}").alias(n) for i, n in enumerate(("p50", "p95", "p99"))],
                      "success_rate", "sla_rate")
