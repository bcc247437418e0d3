"""Bronze, Silver and Gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.catalogue import REGIONS
from assaylake.contract import Contract, RuleSpec
from assaylake.functions.text import iso_to_date, iso_to_timestamp, percent, quarter_label, quarter_start
from assaylake.operators.joins import with_lookup
from assaylake.operators.keys import latest_by
from assaylake.sources.tables import inline_dimension, passed_rows

PASS = "pass"
# Quality flags.
INVALID_DATES = "soft_violation_invalid_dates"
OVER_BUDGET = "soft_violation_over_budget"
INVALID_STATUS = "soft_violation_invalid_status"
NEGATIVE_BUDGET = "soft_violation_budget_negative"
FUTURE_ACQUISITION = "soft_violation_future_acquisition"
EARLY_ASSIGNMENT = "soft_violation_assignment_before_acquisition"


def typed(name: str, dtype: str) -> Column:
    """A staged text column as the Bronze type of its field."""
    c = F.col(name)
    if dtype == "date":
        return iso_to_date(c)
    if dtype == "float":
        return c.try_cast("decimal(18,2)")
    return c.try_cast({"integer": "bigint", "boolean": "boolean"}.get(dtype, "string"))


def bronze(staging: DataFrame, contract: Contract, run_id: str) -> DataFrame:
    """Typed rows that passed validation, every batch kept. ``dt`` is the day of ingestion."""
    at = iso_to_timestamp(F.col("_ingested_at"))
    return passed_rows(staging).select(
        *[typed(f.name, f.dtype).alias(f.name) for f in contract.fields],
        at.alias("last_updated_at"), at.cast("date").alias("dt"), F.lit(run_id).alias("run_id"),
        *[c for c in ("_source_id", "_batch_id") if c in staging.columns],
    )


def first_flag(*branches: tuple[Column, str]) -> Column:
    """The name of the first condition that holds, else ``pass``. Unknown counts as not held."""
    out = F.lit(PASS)
    for condition, name in reversed(branches):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def project_flag(extended: bool = False, statuses: Sequence[str] = ()) -> Column:
    """Dates out of order, then over budget; optionally a bad status or a negative budget too."""
    branches = [
        (F.col("end_date") <= F.col("start_date"), INVALID_DATES),
        (F.col("budget_utilized_php") > F.col("budget_allocated_php"), OVER_BUDGET),
    ]
    if extended:
        if statuses:
            branches.append((~F.col("status").isin(list(statuses)), INVALID_STATUS))
        branches.append((F.col("budget_allocated_php") < 0, NEGATIVE_BUDGET))
    return first_flag(*branches)


def region_dimension(spark) -> DataFrame:
    return inline_dimension(spark, REGIONS, "region_code string, region_name string")


def silver_projects(
    bronze_df: DataFrame, regions: DataFrame, ties: Sequence[str] = ("_source_id", "_batch_id"),
    extended_flags: bool = False, statuses: Sequence[str] = (),
) -> DataFrame:
    """The latest submission per project with its region name, utilization and quality flag."""
    have = [t for t in ties if t in bronze_df.columns]
    latest = latest_by(bronze_df, ["project_id"], ["last_updated_at"], have)
    named = with_lookup(latest, regions, "region", "region_code", "region_name", "region_name")
    return named.select(
        "project_id", "agency", F.col("region").alias("region_code"), "region_name", "program_area",
        "project_title", "principal_investigator", "start_date", "end_date", "budget_allocated_php",
        "budget_utilized_php",
        percent(F.col("budget_utilized_php"), F.col("budget_allocated_php")).alias("budget_utilization_pct"),
        project_flag(extended_flags, statuses).alias("quality_flag"), "status", "funding_source",
    )


def equipment_flag(today: Column) -> Column:
    return first_flag(
        (F.col("acquisition_date") > today, FUTURE_ACQUISITION),
        (F.col("last_assignment_date") < F.col("acquisition_date"), EARLY_ASSIGNMENT),
    )


def silver_equipment(
    bronze_df: DataFrame, today: Column | None = None, ties: Sequence[str] = ("_source_id", "_batch_id"),
) -> DataFrame:
    """The latest row per piece of equipment with its quality flag."""
    have = [t for t in ties if t in bronze_df.columns]
    latest = latest_by(bronze_df, ["equipment_id"], ["last_updated_at"], have)
    return latest.select(
        "equipment_id", "agency", "equipment_name", "equipment_category", "acquisition_date",
        "acquisition_cost_php", "condition_status", "custodian_name", "assigned_office", "last_assignment_date",
        equipment_flag(today if today is not None else F.current_date()).alias("quality_flag"),
    )


def portfolio_performance(silver: DataFrame, include_flagged: bool = True) -> DataFrame:
    """Budget and utilization by agency, program, region, quarter and status. Silver holds each project once."""
    rows = silver if include_flagged else silver.filter(F.col("quality_flag") == PASS)
    allocated, utilized = F.sum("budget_allocated_php"), F.sum("budget_utilized_php")
    return rows.groupBy(
        "agency", "program_area", "region_code", "region_name", quarter_start(F.col("start_date")).alias("quarter"),
        "status",
    ).agg(
        F.count("project_id").alias("project_count"),
        allocated.alias("total_budget_allocated_php"), utilized.alias("total_budget_utilized_php"),
        percent(utilized, allocated).alias("utilization_rate_pct"),
    )


PORTFOLIO_ORDER = ("quarter", "agency", "program_area")
EQUIPMENT_ORDER = ("agency", "equipment_category", "condition_status")


def portfolio_detail(silver: DataFrame, passing_only: bool = True) -> DataFrame:
    """The richer rollup: quarter labels, quality issues, first start and last end."""
    rows = silver.filter(F.col("quality_flag") == PASS) if passing_only else silver
    allocated, utilized = F.sum("budget_allocated_php"), F.sum("budget_utilized_php")
    return rows.groupBy(
        quarter_label(F.col("start_date")).alias("quarter"), "agency", "program_area", "region_code", "status",
    ).agg(
        F.count("project_id").alias("project_count"),
        F.count(F.when(F.col("quality_flag") != PASS, F.col("project_id"))).alias("quality_issues"),
        allocated.alias("total_budget_allocated_php"), utilized.alias("total_budget_utilized_php"),
        percent(utilized, allocated).alias("utilization_rate_pct"),
        F.min("start_date").alias("earliest_start"), F.max("end_date").alias("latest_end"),
    )


def equipment_summary(silver: DataFrame) -> DataFrame:
    """Count, total and average cost by agency, category and condition."""
    return silver.groupBy("agency", "equipment_category", "condition_status").agg(
        F.count("equipment_id").alias("equipment_count"),
        F.sum("acquisition_cost_php").alias("total_acquisition_cost_php"),
        F.round(F.avg("acquisition_cost_php"), 2).alias("avg_acquisition_cost_php"),
    )


def layer_table(layer: str, name: str) -> str:
    """Physical table name: the layer is the schema as it stands."""
    return f"{layer.strip()}.{name}" if layer else name


# Checks that run after each layer.
MODEL_TESTS: Mapping[str, tuple[RuleSpec, ...]] = {
    "bronze_project_monitoring": tuple(
        RuleSpec(f"bronze_{c}", "not_null", c) for c in ("project_id", "last_updated_at", "dt")),
    "silver_project_monitoring": (
        RuleSpec("silver_key", "not_null", "project_id"), RuleSpec("silver_unique", "unique", "project_id"),
        RuleSpec("silver_rate", "between", "budget_utilization_pct", "soft", {"low": 0, "high": 100}),
        RuleSpec("silver_flag", "in_set", "quality_flag", "soft", {"values": [PASS, OVER_BUDGET, INVALID_DATES]}),
    ),
    "gold_portfolio_performance": (
        RuleSpec("gold_rate", "between", "utilization_rate_pct", "hard", {"low": 0, "high": 100}),
    ),
    "bronze_rd_equipment_inventory": tuple(
        RuleSpec(f"bronze_{c}", "not_null", c) for c in ("equipment_id", "last_updated_at", "dt")),
    "silver_rd_equipment_inventory": (
        RuleSpec("silver_key", "not_null", "equipment_id"), RuleSpec("silver_unique", "unique", "equipment_id"),
        RuleSpec("silver_flag", "in_set", "quality_flag", "soft",
                 {"values": [PASS, FUTURE_ACQUISITION, EARLY_ASSIGNMENT]}),
    ),
    "gold_equipment_summary": (RuleSpec("gold_count", "not_null", "equipment_count"),),
}
