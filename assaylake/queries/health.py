"""Profiles, drift, run statistics, snapshots and incremental pulls."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import profile, rules
from assaylake.plans import reports
from assaylake.queries import inputs
from assaylake.queries.registry import day, dbl, query, stamp, table
from assaylake.queries.validation import _ANY, _DEFECTS, _judged
from assaylake.sinks import logs, staging
from assaylake.sources import tables
from assaylake.streaming import changes


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with values missing here and there."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select("o_orderkey", "o_custkey", F.when(key % 9 != 0, F.col("o_orderstatus")).alias("status"),
                    F.when(key % 4 != 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("price"), F.col("o_orderdate").cast("date").alias("ordered"))


_GAPPY = """
gappy as (select o_orderkey, o_custkey, case when o_orderkey % 9 <> 0 then o_orderstatus end as status,
          case when o_orderkey % 4 <> 0 then cast(o_totalprice as decimal(18,2)) end as price, cast(o_orderdate as date) as ordered from orders)"""


def _profile_sql(column: str, mean: str) -> str:
    return f"""select '{column}' as "column", count(*) as row_count, count(*) - count({column}) as null_count,
       round((count(*) - count({column})) * 100.0::double / count(*), 2) as null_pct, count(distinct {column}) as distinct_count,
       cast(min({column}) as varchar) as min_value, cast(max({column}) as varchar) as max_value, {mean} as mean_value from gappy"""


@query("column_profile", "with " + _GAPPY + " union all ".join([
    _profile_sql("o_orderkey", "round(avg(o_orderkey), 4)"), _profile_sql("o_custkey", "round(avg(o_custkey), 4)"), _profile_sql("status", "null::double"),
    _profile_sql("price", "round(cast(sum(price) as double) / count(price), 4)"), _profile_sql("ordered", "null::double")]))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, distinct values, range and mean of every column, exact."""
    out = profile.column_profile(gappy_orders(spark, sf_dir), exact=True)
    return out.withColumns({"null_pct": dbl("null_pct"), "mean_value": F.round("mean_value", 4)})


@query("completeness_check", "with " + _GAPPY + """
select 'status' as "column", cast(count(status) as double) / count(*) as share, cast(cast(count(status) as double) / count(*) >= 0.85 as bigint) as complete from gappy
union all select 'price', cast(count(price) as double) / count(*), cast(cast(count(price) as double) / count(*) >= 0.85 as bigint) from gappy""")
def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.completeness(gappy_orders(spark, sf_dir), {"status": 0.85, "price": 0.85})
    return out.withColumn("complete", F.col("complete").cast("bigint"))


_HALVES = """
halves as (select ts < timestamp '2024-01-16' as early, user_id, case when ts >= timestamp '2024-01-16' and event_id % 8 = 0 then null else event_type end as event_type from events),
p as (select early, c, count(*) as n, count(v) as filled, count(distinct v) as d from (
        select early, 'user_id' as c, cast(user_id as varchar) as v from halves union all select early, 'event_type', event_type from halves) group by 1, 2),
q as (select a.c as "column", round((a.n - a.filled) * 100.0::double / a.n, 2) as null_before, a.filled - a.d as dup_before,
             round((b.n - b.filled) * 100.0::double / b.n, 2) as null_after, b.filled - b.d as dup_after
      from p a join p b on a.c = b.c and a.early and not b.early)"""


def event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e, cut = table(spark, sf_dir, "events"), F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    late = (F.col("ts") >= cut) & (F.col("event_id") % 8 == 0)
    e = e.withColumn("event_type", F.when(~late, F.col("event_type")))
    return e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut)


@query("profile_drift", "with " + _HALVES + """
select *, 'high_null_rate' as alert from q where null_after > 5 and null_after > null_before
union all select *, 'duplicate_increase' from q where dup_after > dup_before * 0.9""")
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the events compared by their profiles."""
    sides = [profile.column_profile(h, ["user_id", "event_type"], exact=True) for h in event_halves(spark, sf_dir)]
    out = profile.drift(*sides, null_pct=5.0, duplicate_growth=0.9)
    return out.withColumns({"null_before": dbl("null_before"), "null_after": dbl("null_after")})


@query("new_values", """
with a as (select distinct o_custkey from orders where o_orderdate < timestamp '1996-01-01')
select o_custkey, count(*) as row_count from orders where o_orderdate >= timestamp '1996-01-01' and o_custkey not in (select o_custkey from a) group by 1""")
def new_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a column that were not there before."""
    o, cut = table(spark, sf_dir, "orders"), F.lit(datetime(1996, 1, 1)).cast("timestamp_ntz")
    return profile.new_values(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut), "o_custkey")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs of a dataset: the value is the duration in cents of a second."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("dataset_"), F.col("user_id") % 20).alias("dataset_name"), F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"), F.round(F.col("value") * 100).cast("bigint").alias("duration"))


@query("run_statistics", """
select 'dataset_' || (user_id % 20) as dataset_name, event_type as status, count(*) as job_count,
       round(cast(sum(cast(round(value * 100) as bigint)) as double) / count(*), 4) as avg_duration
from events where ts >= timestamp '2024-01-24' group by 1, 2""")
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and mean duration of the last seven days before a moment."""
    since = F.lit(datetime(2024, 1, 31)).cast("timestamp_ntz") - F.expr("interval 7 days")
    out = reports.run_statistics(runs(spark, sf_dir), since, "dataset_name", "status", "created_at", "duration")
    return out.withColumn("avg_duration", F.round("avg_duration", 4))


@query("duration_percentiles", """
select 'dataset_' || (user_id % 20) as dataset_name, count(*) as runs,
       round(quantile_cont(cast(round(value * 100) as bigint), 0.5), 4) as p50, round(quantile_cont(cast(round(value * 100) as bigint), 0.95), 4) as p95,
       round(quantile_cont(cast(round(value * 100) as bigint), 0.99), 4) as p99,
       round(avg(case when event_type <> 'error' then 1.0 else 0.0 end), 6) as success_rate,
       round(avg(case when cast(round(value * 100) as bigint) <= 5000 then 1.0 else 0.0 end), 6) as sla_rate
from events group by 1""")
def duration_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.duration_metrics(runs(spark, sf_dir), ["dataset_name"], "duration", F.col("status") != "error", 5000, exact=True)
    return out.withColumns({**{p: F.round(p, 4) for p in ("p50", "p95", "p99")}, **{r: F.round(r, 6) for r in ("success_rate", "sla_rate")}})


@query("run_log_latest", """
select user_id as execution_id, event_type as status, strftime(ts, '%Y-%m-%d %H:%M:%S') as logged_at from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def run_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest entry of every run."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("execution_id"), F.col("event_type").alias("status"), "event_id", F.col("ts").alias("logged_at"))
    return logs.latest_runs(e, ties=("event_id",)).select("execution_id", "status", stamp("logged_at").alias("logged_at"))


@query("run_failures", "with " + _DEFECTS + """
select 'hard' as severity, cast((max(f1::int) + max(f2::int) + max(f3::int) + max(f4::int) + max(f5::int) + max(f8::int) + max(f10::int) + max(f11::int)) as bigint) as failed from checks
union all select 'soft', cast((max(f6::int) + max(f7::int) + max(f9::int)) as bigint) from checks""")
def run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rules by severity, from the rule results."""
    rows, compiled = _judged(spark, sf_dir)
    results = rules.rule_results(rows, compiled)
    hard, soft = rules.failed_rules(results), rules.failed_rules(results, "soft")
    return hard.agg(F.count("*").alias("failed")).withColumn("severity", F.lit("hard")).unionByName(
        soft.agg(F.count("*").alias("failed")).withColumn("severity", F.lit("soft")))


@query("dataset_headline", "with " + _DEFECTS + f"""
select round((count(line_id) + count(quantity) + count(flag) + count(allocated) + count(utilized) + count(ordered) + count(shipped)) * 100.0::double / (count(*) * 7), 2) as completeness_pct,
       round(avg(case when {_ANY} then 0.0 else 1.0 end) * 100, 1) as validation_score,
       date_diff('hour', max(shipped)::timestamp, timestamp '2002-01-01') as age_hours
from checks""")
def dataset_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness, freshness and validation score of a dataset."""
    rows, compiled = _judged(spark, sf_dir)
    flagged = rules.flagged(rows, compiled)
    names = ["line_id", "quantity", "flag", "allocated", "utilized", "ordered", "shipped", rules.FAILURES]
    ready = flagged.select(*names).withColumn("shipped", F.col("shipped").cast("timestamp_ntz"))
    out = profile.headline(ready, "shipped", F.lit(datetime(2002, 1, 1)).cast("timestamp_ntz"), rules.FAILURES)
    return out.withColumn("completeness_pct", dbl("completeness_pct"))


@query("snapshot_as_of", """
with s as (select *, cast(date_trunc('month', o_orderdate) as date) as snapshot from orders)
select strftime(snapshot, '%Y-%m-%d') as snapshot, count(*) as row_count, count(distinct o_custkey) as unique_keys from s
where snapshot = (select max(snapshot) from s where snapshot <= date '1997-08-15') group by 1""")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly snapshots read as they stood on a day."""
    snaps = table(spark, sf_dir, "orders").withColumn("snapshot", F.date_trunc("month", "o_orderdate").cast("date"))
    at = tables.as_of(snaps, "snapshot", datetime(1997, 8, 15).date())
    return at.groupBy("snapshot").agg(F.count("*").alias("row_count"), F.count_distinct("o_custkey").alias("unique_keys")).select(
        day("snapshot").alias("snapshot"), "row_count", "unique_keys")


@query("snapshot_counts", "select count(*) as row_count, count(distinct o_custkey) as unique_keys from orders where o_orderdate < timestamp '1997-08-15'")
def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.lit(datetime(1997, 8, 15)).cast("timestamp_ntz")
    return reports.snapshot_counts(table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < cut), "o_custkey")


@query("incremental_cursor", """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as ordered from orders
where o_orderdate > (select max(o_orderdate) from orders where o_orderstatus = 'F' and o_orderdate < timestamp '2001-01-01')""")
def incremental_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows past the newest one already held."""
    o = table(spark, sf_dir, "orders")
    held = o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz")))
    return changes.since_cursor(o, "o_orderdate", held).select("o_orderkey", day("o_orderdate").alias("ordered"))


@query("retention_expire", """
select event_type, count(*) as kept from events where cast(ts as date) > date '2024-01-30' - 14 group by 1""")
def retention_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fourteen-day retention leaves."""
    e = table(spark, sf_dir, "events")
    return staging.expired(e, "ts", 14, F.lit("2024-01-30").cast("date")).groupBy("event_type").agg(F.count("*").alias("kept"))


@query("schema_evolution", """
select o_orderkey, o_orderstatus, null::varchar as o_orderpriority from orders where o_orderdate < timestamp '1997-01-01'
union all select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderdate >= timestamp '1997-01-01'""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches written before a column existed beside those that have it."""
    o, cut = table(spark, sf_dir, "orders"), F.lit(datetime(1997, 1, 1)).cast("timestamp_ntz")
    old = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus")
    return tables.evolved([old, o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderstatus", "o_orderpriority")])


@query("quality_index_by_agency", "with " + inputs.SILVER + """
select agency, round(avg(case when quality_flag = 'pass' then 1.0 else 0.0 end) * 100, 1) as quality from silver group by 1""")
def quality_index_by_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of rows without a failure per agency."""
    s = inputs.silver(spark, sf_dir)
    failures = F.when(F.col("quality_flag") != "pass", F.array("quality_flag")).otherwise(F.array().cast("array<string>"))
    return s.withColumn("f", failures).groupBy("agency").agg(rules.quality_index(F.col("f")).alias("quality"))
