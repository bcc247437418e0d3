"""Bronze, Silver, Gold and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.plans import medallion, reports
from assaylake.queries import inputs
from assaylake.queries.registry import day, dbl, query, stamp, table

_BRONZE_OUT = """select project_id, agency, region, project_title, strftime(start_date, '%Y-%m-%d') as start_date,
       strftime(end_date, '%Y-%m-%d') as end_date, cast(budget_allocated_php as double) as budget_allocated_php,
       cast(budget_utilized_php as double) as budget_utilized_php, status,
       strftime(last_updated_at, '%Y-%m-%d %H:%M:%S') as last_updated_at, strftime(dt, '%Y-%m-%d') as dt, 'run-1' as run_id """


@query("bronze_typed", "with " + inputs.BRONZE + _BRONZE_OUT + "from bronze")
def bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged text that passed validation, typed."""
    return inputs.bronze(spark, sf_dir).select(
        "project_id", "agency", "region", "project_title", day("start_date").alias("start_date"), day("end_date").alias("end_date"),
        dbl("budget_allocated_php").alias("budget_allocated_php"), dbl("budget_utilized_php").alias("budget_utilized_php"),
        "status", stamp("last_updated_at").alias("last_updated_at"), day("dt").alias("dt"), "run_id")


@query("silver_latest", "with " + inputs.SILVER + """
select project_id, project_title, strftime(last_updated_at, '%Y-%m-%d %H:%M:%S') as last_updated_at from ranked where rn = 1""")
def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest submission per project."""
    latest = medallion.latest_by(inputs.bronze(spark, sf_dir), ["project_id"], ["last_updated_at"], ["project_title"])
    return latest.select("project_id", "project_title", stamp("last_updated_at").alias("last_updated_at"))


@query("silver_flagged", "with " + inputs.SILVER + """
select project_id, agency, region_code, region_name, program_area, project_title, strftime(start_date, '%Y-%m-%d') as start_date,
       cast(budget_allocated_php as double) as budget_allocated_php, budget_utilization_pct, quality_flag, status from silver""")
def silver_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.silver(spark, sf_dir).select(
        "project_id", "agency", "region_code", "region_name", "program_area", "project_title", day("start_date").alias("start_date"),
        dbl("budget_allocated_php").alias("budget_allocated_php"), dbl("budget_utilization_pct").alias("budget_utilization_pct"),
        "quality_flag", "status")


_GOLD_OUT = """select agency, program_area, region_code, region_name, strftime(quarter, '%Y-%m-%d') as quarter, status, project_count,
       cast(total_budget_allocated_php as double) as total_budget_allocated_php,
       cast(total_budget_utilized_php as double) as total_budget_utilized_php, utilization_rate_pct from gold"""


def _gold_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "agency", "program_area", "region_code", "region_name", day("quarter").alias("quarter"), "status", "project_count",
        dbl("total_budget_allocated_php").alias("total_budget_allocated_php"),
        dbl("total_budget_utilized_php").alias("total_budget_utilized_php"), dbl("utilization_rate_pct").alias("utilization_rate_pct"))


@query("gold_rollup", "with " + inputs.GOLD + _GOLD_OUT)
def gold_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From staged text to the portfolio table, in Gold order."""
    return _gold_columns(inputs.gold(spark, sf_dir)).orderBy(*medallion.PORTFOLIO_ORDER)


@query("gold_rollup_detail", "with " + inputs.SILVER + """
select cast(year(start_date) as varchar) || '-Q' || quarter(start_date) as quarter, agency, program_area, region_code, status,
       count(distinct project_id) as project_count, count(distinct case when quality_flag <> 'pass' then project_id end) as quality_issues,
       cast(sum(budget_allocated_php) as double) as total_budget_allocated_php,
       round(cast(sum(budget_utilized_php) as double) / nullif(cast(sum(budget_allocated_php) as double), 0) * 100, 1) as utilization_rate_pct,
       strftime(min(start_date), '%Y-%m-%d') as earliest_start, strftime(max(end_date), '%Y-%m-%d') as latest_end
from silver group by 1, 2, 3, 4, 5""")
def gold_rollup_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.portfolio_detail(inputs.silver(spark, sf_dir), passing_only=False).select(
        "quarter", "agency", "program_area", "region_code", "status", "project_count", "quality_issues",
        dbl("total_budget_allocated_php").alias("total_budget_allocated_php"), dbl("utilization_rate_pct").alias("utilization_rate_pct"),
        day("earliest_start").alias("earliest_start"), day("latest_end").alias("latest_end"))


@query("gold_rollup_pass_only", "with " + inputs.SILVER + """
select cast(year(start_date) as varchar) || '-Q' || quarter(start_date) as quarter, agency, status,
       count(distinct project_id) as project_count from silver where quality_flag = 'pass' group by 1, 2, 3""")
def gold_rollup_pass_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.silver(spark, sf_dir).withColumns({"program_area": F.lit("all"), "region_code": F.lit("all")})
    return medallion.portfolio_detail(rows).select("quarter", "agency", "status", "project_count")


@query("equipment_silver", "with " + inputs.EQUIPMENT + """
select equipment_id, equipment_category, strftime(acquisition_date, '%Y-%m-%d') as acquisition_date,
       cast(acquisition_cost_php as double) as acquisition_cost_php, condition_status,
       strftime(last_assignment_date, '%Y-%m-%d') as last_assignment_date, quality_flag from silver_equipment""")
def equipment_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.silver_equipment(spark, sf_dir).select(
        "equipment_id", "equipment_category", day("acquisition_date").alias("acquisition_date"),
        dbl("acquisition_cost_php").alias("acquisition_cost_php"), "condition_status",
        day("last_assignment_date").alias("last_assignment_date"), "quality_flag")


@query("equipment_rollup", "with " + inputs.EQUIPMENT + """
select agency, equipment_category, condition_status, count(distinct equipment_id) as equipment_count,
       cast(sum(acquisition_cost_php) as double) as total_acquisition_cost_php,
       round(cast(sum(acquisition_cost_php) as double) / count(acquisition_cost_php), 2) as avg_acquisition_cost_php
from silver_equipment group by 1, 2, 3""")
def equipment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.equipment_summary(inputs.silver_equipment(spark, sf_dir)).select(
        "agency", "equipment_category", "condition_status", "equipment_count",
        dbl("total_acquisition_cost_php").alias("total_acquisition_cost_php"),
        dbl("avg_acquisition_cost_php").alias("avg_acquisition_cost_php")).orderBy(*medallion.EQUIPMENT_ORDER)


@query("violation_summary", "with " + inputs.SILVER + """
select quality_flag, count(*) as violation_count, round(count(*) * 100.0::double / (select count(*) from silver), 2) as pct_of_total
from silver where quality_flag <> 'pass' group by 1""")
def violation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.violations(inputs.silver(spark, sf_dir)).select(
        "quality_flag", "violation_count", dbl("pct_of_total").alias("pct_of_total"))


@query("violating_rows_top", "with " + inputs.SILVER + """
select quality_flag, agency, project_id, program_area from silver where quality_flag <> 'pass'
order by quality_flag, agency, project_id limit 20""")
def violating_rows_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.violating_rows(inputs.silver(spark, sf_dir), 20).select("quality_flag", "agency", "project_id", "program_area")


@query("best_utilization_top", "with " + inputs.GOLD + """
select agency, program_area, region_code, strftime(quarter, '%Y-%m-%d') as quarter, status, utilization_rate_pct from gold
where quarter >= date '1998-07-01' order by utilization_rate_pct desc nulls last, agency, program_area, region_code, quarter, status limit 10""")
def best_utilization_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_utilization(inputs.gold(spark, sf_dir), "1998-07-01", 10).select(
        "agency", "program_area", "region_code", day("quarter").alias("quarter"), "status", dbl("utilization_rate_pct").alias("utilization_rate_pct"))


@query("extended_flags", "with " + inputs.SILVER + """
select case when end_date <= start_date then 'soft_violation_invalid_dates'
            when budget_utilized_php > budget_allocated_php then 'soft_violation_over_budget'
            when status not in ('F', 'O') then 'soft_violation_invalid_status' else 'pass' end as quality_flag, count(*) as n
from silver group by 1""")
def extended_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags with the status check added."""
    rows = medallion.silver_projects(inputs.bronze(spark, sf_dir), inputs.nation_dimension(spark, sf_dir), ["project_title"], True, ["F", "O"])
    return rows.groupBy("quality_flag").agg(F.count("*").alias("n"))


@query("layer_trace", "with " + inputs.GOLD + """,
pick as (select min(project_id) as p from silver), ag as (select min(agency) as a from silver, pick where project_id = p)
select 'Bronze' as layer, count(*) as row_count, strftime(max(last_updated_at), '%Y-%m-%d %H:%M:%S') as last_seen from bronze, pick where project_id = p
union all select 'Silver', count(*), null from silver, pick where project_id = p
union all select 'Gold', count(*), null from gold, ag where agency = a""")
def layer_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One project followed through all three layers."""
    b, s = inputs.bronze(spark, sf_dir), inputs.silver(spark, sf_dir)
    first = s.agg(F.min("project_id").alias("p")).scalar()
    return reports.layer_trace(b, s, medallion.portfolio_performance(s), first).select(
        "layer", "row_count", stamp("last_seen").alias("last_seen"))


@query("federated_registry_join", """
select s_suppkey as dataset_id, s_name as dataset_name, count(*) as row_count, cast(sum(cast(l_quantity as bigint)) as bigint) as units
from supplier join lineitem on l_suppkey = s_suppkey group by 1, 2""")
def federated_registry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry beside what the lake holds per dataset: aggregated first, then joined."""
    facts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("dataset_id")).agg(
        F.count("*").alias("row_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
    registry = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("dataset_id"), F.col("s_name").alias("dataset_name"))
    return reports.with_registry(registry, facts, "dataset_id")
