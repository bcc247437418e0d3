"""Raw, staged and defective inputs derived from the test tables, and the same derivations in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.catalogue import PROJECT_MONITORING, RD_EQUIPMENT_INVENTORY
from assaylake.functions.transforms import CURRENCY_TO_FLOAT, DATE_US_TO_ISO
from assaylake.contract import Alias
from assaylake.plans import medallion
from assaylake.queries.registry import query, table

RUN = "run-1"


def cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def money_text(c: Column) -> Column:
    """Whole cents as decimal text."""
    whole = (c - c % 100) / 100
    return F.concat(whole.cast("bigint").cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def utilized_text(price: Column, key: Column) -> Column:
    """0 to 119 percent of a price, in whole cents, as text."""
    share = cents(price) * (key % 120)
    return money_text(((share - share % 100) / 100).cast("bigint"))


def end_date(start: Column, key: Column) -> Column:
    """An end date from 20 days before the start on; every eleventh is missing."""
    return F.when(key % 11 != 0, F.date_add(start.cast("date"), (key % 400 - 20).cast("int")))


SUBMISSION_ALIASES = (
    Alias("Proj_ID", "project_id"), Alias("Ref", "project_title"), Alias("Program", "program_area"),
    Alias("Start_Date (mm/dd/yyyy)", "start_date", DATE_US_TO_ISO),
    Alias("End_Date (mm/dd/yyyy)", "end_date", DATE_US_TO_ISO),
    Alias("Budget Allocated (Php)", "budget_allocated_php", CURRENCY_TO_FLOAT),
    Alias("Budget Utilized (Php)", "budget_utilized_php", CURRENCY_TO_FLOAT),
    Alias("Status", "status"),
)


def raw_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders the way a regional office would send them: US dates, currency text."""
    o = table(spark, sf_dir, "orders")
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        F.concat(F.lit("P-"), F.col("o_custkey")).alias("Proj_ID"),
        F.concat(F.lit("Order "), key).alias("Ref"),
        F.col("o_orderpriority").alias("Program"),
        F.date_format(start, "MM/dd/yyyy").alias("Start_Date (mm/dd/yyyy)"),
        F.coalesce(F.date_format(end_date(start, key), "M/d/yyyy"), F.lit("")).alias("End_Date (mm/dd/yyyy)"),
        F.concat(F.lit("Php "), F.format_number("o_totalprice", 2)).alias("Budget Allocated (Php)"),
        F.concat(F.lit("Php "), utilized_text(F.col("o_totalprice"), key)).alias("Budget Utilized (Php)"),
        F.col("o_orderstatus").alias("Status"),
    )


def staged_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers as rows of the project staging table, all text."""
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        F.concat(F.lit("P-"), F.col("o_custkey")).alias("project_id"), F.col("c_mktsegment").alias("agency"),
        F.col("c_nationkey").cast("string").alias("region"), F.col("o_orderpriority").alias("program_area"),
        F.concat(F.lit("Order "), key).alias("project_title"), F.col("c_name").alias("principal_investigator"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(end_date(start, key), "yyyy-MM-dd").alias("end_date"),
        money_text(cents(F.col("o_totalprice"))).alias("budget_allocated_php"),
        utilized_text(F.col("o_totalprice"), key).alias("budget_utilized_php"),
        F.col("o_orderstatus").alias("status"), F.lit("GAA").alias("funding_source"),
        F.when(key % 13 == 0, "fail").otherwise("pass").alias("_validation_status"),
        F.concat(F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("_ingested_at"),
    )


def nation_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("region_code"),
        F.concat_ws(" / ", "r_name", "n_name").alias("region_name"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.bronze(staged_projects(spark, sf_dir), PROJECT_MONITORING, RUN)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_projects(bronze(spark, sf_dir), nation_dimension(spark, sf_dir), ["project_title"])


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.portfolio_performance(silver(spark, sf_dir))


def staged_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as equipment records of a supplier, all text."""
    li = table(spark, sf_dir, "lineitem")
    when, key = F.col("l_shipdate").cast("date"), F.col("l_orderkey")
    return li.select(
        F.concat_ws("-", F.lit("E"), "l_partkey", "l_suppkey").alias("equipment_id"), F.lit("PCAARRD").alias("agency"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("equipment_name"), F.col("l_returnflag").alias("equipment_category"),
        F.date_format(when, "yyyy-MM-dd").alias("acquisition_date"),
        money_text(cents(F.col("l_extendedprice"))).alias("acquisition_cost_php"),
        F.col("l_linestatus").alias("condition_status"),
        F.concat(F.lit("Keeper "), F.col("l_suppkey")).alias("custodian_name"),
        F.lit(None).cast("string").alias("assigned_office"),
        F.when(key % 7 != 0, F.date_format(F.date_add(when, (key % 40 - 10).cast("int")), "yyyy-MM-dd")).alias("last_assignment_date"),
        F.lit("pass").alias("_validation_status"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("_ingested_at"),
        F.concat_ws("-", F.lpad(key.cast("string"), 12, "0"), "l_linenumber", F.lpad(cents(F.col("l_extendedprice")).cast("string"), 12, "0"),
                    F.lpad(F.col("l_quantity").cast("int").cast("string"), 4, "0"), cents(F.col("l_discount")), cents(F.col("l_tax")), "l_returnflag", "l_linestatus").alias("_batch_id"),
    )


TODAY = "2001-06-01"


def silver_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = medallion.bronze(staged_equipment(spark, sf_dir), RD_EQUIPMENT_INVENTORY, RUN)
    return medallion.silver_equipment(b, F.lit(TODAY).cast("date"), ["_batch_id"])


# --- the same in SQL -------------------------------------------------------------------------------

def sql_money(expr: str) -> str:
    return f"cast(cast(({expr}) // 100 as varchar) || '.' || lpad(cast(({expr}) % 100 as varchar), 2, '0') as decimal(18,2))"


_UTIL = "((cast(round(o_totalprice * 100) as bigint) * (o_orderkey % 120)) // 100)"

SUBMISSIONS = f"""
submissions as (
  select o_orderkey, o_custkey, 'P-' || o_custkey as project_id, 'Order ' || o_orderkey as project_title,
         o_orderpriority as program_area, o_orderstatus as status, o_orderdate,
         cast(o_orderdate as date) as start_date,
         case when o_orderkey % 11 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 400 - 20 as integer) end as end_date,
         {sql_money('cast(round(o_totalprice * 100) as bigint)')} as budget_allocated_php,
         {sql_money(_UTIL)} as budget_utilized_php
  from orders)"""

BRONZE = SUBMISSIONS + """,
bronze as (
  select s.project_id, c_mktsegment as agency, cast(c_nationkey as varchar) as region, s.program_area,
         s.project_title, c_name as principal_investigator, s.start_date, s.end_date, s.budget_allocated_php,
         s.budget_utilized_php, s.status, o_orderdate as last_updated_at, cast(o_orderdate as date) as dt
  from submissions s join customer on c_custkey = s.o_custkey
  where s.o_orderkey % 13 <> 0)"""

SILVER = BRONZE + """,
dim as (
  select cast(n_nationkey as varchar) as region_code, r_name || ' / ' || n_name as region_name
  from nation join region on n_regionkey = r_regionkey),
ranked as (
  select *, row_number() over (partition by project_id order by last_updated_at desc, project_title desc) as rn
  from bronze),
silver as (
  select project_id, agency, region as region_code, region_name, program_area, project_title, start_date, end_date,
         budget_allocated_php, budget_utilized_php,
         round(cast(budget_utilized_php as double) / nullif(cast(budget_allocated_php as double), 0) * 100, 1) as budget_utilization_pct,
         case when end_date <= start_date then 'soft_violation_invalid_dates'
              when budget_utilized_php > budget_allocated_php then 'soft_violation_over_budget'
              else 'pass' end as quality_flag,
         status
  from ranked left join dim on ranked.region = dim.region_code where rn = 1)"""

GOLD = SILVER + """,
gold as (
  select agency, program_area, region_code, region_name, cast(date_trunc('quarter', start_date) as date) as quarter, status,
         count(distinct project_id) as project_count, sum(budget_allocated_php) as total_budget_allocated_php,
         sum(budget_utilized_php) as total_budget_utilized_php,
         round(cast(sum(budget_utilized_php) as double) / nullif(cast(sum(budget_allocated_php) as double), 0) * 100, 1) as utilization_rate_pct
  from silver group by 1, 2, 3, 4, 5, 6)"""

EQUIPMENT = f"""
equipment as (
  select 'E-' || l_partkey || '-' || l_suppkey as equipment_id, 'PCAARRD' as agency, l_returnflag as equipment_category,
         cast(l_shipdate as date) as acquisition_date,
         {sql_money('cast(round(l_extendedprice * 100) as bigint)')} as acquisition_cost_php, l_linestatus as condition_status,
         case when l_orderkey % 7 <> 0 then cast(l_shipdate as date) + cast(l_orderkey % 40 - 10 as integer) end as last_assignment_date,
         l_shipdate as last_updated_at,
         concat_ws('-', lpad(cast(l_orderkey as varchar), 12, '0'), l_linenumber, lpad(cast(cast(round(l_extendedprice * 100) as bigint) as varchar), 12, '0'),
           lpad(cast(cast(l_quantity as integer) as varchar), 4, '0'), cast(round(l_discount * 100) as bigint), cast(round(l_tax * 100) as bigint), l_returnflag, l_linestatus) as tie
  from lineitem),
latest_equipment as (
  select *, row_number() over (partition by equipment_id order by last_updated_at desc, tie desc) as rn from equipment),
silver_equipment as (
  select equipment_id, agency, equipment_category, acquisition_date, acquisition_cost_php, condition_status, last_assignment_date,
         case when acquisition_date > date '{TODAY}' then 'soft_violation_future_acquisition'
              when last_assignment_date < acquisition_date then 'soft_violation_assignment_before_acquisition'
              else 'pass' end as quality_flag
  from latest_equipment where rn = 1)"""


@query("inline_dimension_names", """
select o_orderstatus as code, case o_orderstatus when 'F' then 'Filled' when 'O' then 'Open' end as name, count(*) as n from orders group by 1, 2""")
def inline_dimension_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes named by a small fixed table; unknown codes have no name."""
    from assaylake.operators.joins import with_lookup
    from assaylake.sources.tables import inline_dimension

    names = inline_dimension(spark, [("F", "Filled"), ("O", "Open")], "status string, label string")
    named = with_lookup(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("code")), names, "code", "status", "label", "name")
    return named.groupBy("code", "name").agg(F.count("*").alias("n"))
