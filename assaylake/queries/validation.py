"""Rules, quality indexes and quarantine over line items with defects derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.contract import Contract, Field, RuleSpec
from assaylake.operators import rules
from assaylake.operators.keys import duplicated_rows
from assaylake.plans import medallion
from assaylake.queries import inputs
from assaylake.queries.registry import joined, query, table
from assaylake.sources import config_tables
from assaylake.sinks import staging

FLAGS = ("A", "N", "R")

LINES = Contract(
    dataset="lines",
    fields=(
        Field("line_id", required=True), Field("quantity", "float", required=True, minimum=3),
        Field("flag", required=True, allowed=FLAGS), Field("allocated", "float"), Field("utilized", "float"),
        Field("ordered", "date"), Field("shipped", "date", required=True),
    ),
    unique_fields=("line_id",),
    rules=(
        RuleSpec("within_allocation", "pair_at_least", "allocated", "hard", {"other": "utilized"}),
        RuleSpec("dates_in_order", "pair_above", "shipped", "soft", {"other": "ordered"}),
        RuleSpec("window", "between", "shipped", "hard", {"low": "1995-06-01", "high": "2001-06-30"}),
    ),
)


def defective_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text with missing, unreadable, repeated and contradictory values."""
    li = table(spark, sf_dir, "lineitem")
    part, supp, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    shipped = F.col("l_shipdate").cast("date")
    return li.select(
        F.when(part % 101 != 0, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("line_id"),
        F.when(part % 97 == 0, None).when(part % 89 == 0, "many").otherwise(
            F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(supp % 17 == 0, "X").otherwise(F.col("l_returnflag")).alias("flag"),
        inputs.money_text(inputs.cents(F.col("l_extendedprice"))).alias("allocated"),
        inputs.utilized_text(F.col("l_extendedprice"), order).alias("utilized"),
        F.when(order % 5 != 0, F.date_format(F.date_add(shipped, (order % 30 - 25).cast("int")), "yyyy-MM-dd")).alias("ordered"),
        F.date_format(shipped, "yyyy-MM-dd").alias("shipped"),
    )


_DEFECTS = f"""
raw as (
  select case when l_partkey % 101 <> 0 then l_orderkey || '-' || l_linenumber end as line_id,
         case when l_partkey % 97 = 0 then null when l_partkey % 89 = 0 then 'many' else cast(cast(l_quantity as integer) as varchar) end as quantity_text,
         case when l_suppkey % 17 = 0 then 'X' else l_returnflag end as flag,
         {inputs.sql_money('cast(round(l_extendedprice * 100) as bigint)')} as allocated,
         {inputs.sql_money('((cast(round(l_extendedprice * 100) as bigint) * (l_orderkey % 120)) // 100)')} as utilized,
         case when l_orderkey % 5 <> 0 then cast(l_shipdate as date) + cast(l_orderkey % 30 - 25 as integer) end as ordered,
         cast(l_shipdate as date) as shipped
  from lineitem),
lines as (
  select *, try_cast(quantity_text as double) as quantity,
         case when line_id is null then 0 else count(*) over (partition by line_id) end as copies from raw),
checks as (
  select *, line_id is null as f1, quantity is null as f2, flag is null as f3, shipped is null as f4, copies > 1 as f5,
         flag not in ('A', 'N', 'R') as f6, coalesce(quantity < 3, false) as f7, allocated < utilized as f8,
         coalesce(shipped <= ordered, false) as f9, (shipped < date '1995-06-01' or shipped > date '2001-06-30') as f10,
         (quantity_text is not null and quantity is null) as f11
  from lines)"""


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[rules.Rule]]:
    return rules.judged(defective_lines(spark, sf_dir), LINES)


@query("validate_row_failures", "with " + _DEFECTS + """
select failures, count(*) as row_count, count(distinct line_id) as line_count from (
  select line_id, concat_ws(',', case when f1 then 'not_null:line_id' end, case when f2 then 'not_null:quantity' end,
    case when f3 then 'not_null:flag' end, case when f4 then 'not_null:shipped' end, case when f5 then 'unique:line_id' end,
    case when f6 then 'in_set:flag' end, case when f7 then 'minimum:quantity' end, case when f8 then 'pair_at_least:allocated' end,
    case when f9 then 'pair_above:shipped' end, case when f10 then 'between:shipped' end, case when f11 then 'type:quantity' end) as failures
  from checks) group by 1""")
def validate_row_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the rules it breaks, summed up by that list."""
    rows, compiled = _judged(spark, sf_dir)
    flagged = rules.flagged(rows, compiled)
    return flagged.groupBy(joined(rules.FAILURES).alias("failures")).agg(
        F.count("*").alias("row_count"), F.count_distinct("line_id").alias("line_count"))


_RESULT_ROWS = [
    ("columns_match", "*", "hard", "0", None), ("not_null", "line_id", "hard", "f1", "null"), ("not_null", "quantity", "hard", "f2", "line_id"),
    ("not_null", "flag", "hard", "f3", "line_id"), ("not_null", "shipped", "hard", "f4", "line_id"), ("unique", "line_id", "hard", "f5", "line_id"),
    ("in_set", "flag", "soft", "f6", "line_id"), ("minimum", "quantity", "soft", "f7", "line_id"),
    ("pair_at_least", "allocated", "hard", "f8", "line_id"), ("pair_above", "shipped", "soft", "f9", "line_id"),
    ("between", "shipped", "hard", "f10", "line_id"), ("type", "quantity", "hard", "f11", "line_id"),
    ("type", "allocated", "hard", "false", None), ("type", "utilized", "hard", "false", None),
    ("type", "ordered", "hard", "false", None), ("type", "shipped", "hard", "false", None),
]

_RESULTS_SQL = "with " + _DEFECTS + ", totals as (select count(*) as n from checks) " + " union all ".join(
    f"""select '{rule}' as rule, '{column}' as "column", '{severity}' as severity, {'count(*) filter (where ' + flag + ')' if flag != '0' else 'count(*) * 0'} as failed_count,
        (select n from totals) as row_count, {'cast(count(*) filter (where ' + flag + ') = 0 as bigint)' if flag != '0' else 'cast(count(*) >= 0 as bigint)'} as success,
        {f"(select coalesce(string_agg(line_id, ',' order by line_id), '') from (select line_id from checks where {flag} and line_id is not null order by line_id limit 5))" if sample else "''"} as sample_ids
        from checks""" for rule, column, severity, flag, sample in _RESULT_ROWS)


@query("validate_rule_results", _RESULTS_SQL)
def validate_rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rule with counts and the five lowest failing ids."""
    rows, compiled = _judged(spark, sf_dir)
    return rules.rule_results(rows, compiled, "line_id").select(
        "rule", "column", "severity", "failed_count", "row_count", F.col("success").cast("bigint").alias("success"),
        joined("sample_ids").alias("sample_ids"))


_ANY = "(f1 or f2 or f3 or f4 or f5 or f6 or f7 or f8 or f9 or f10 or f11)"


@query("validate_dqi", "with " + _DEFECTS + f"""
select 'lines' as dataset, count(*) as row_count, count(*) filter (where {_ANY}) as flagged_rows,
       cast((max(f1::int) + max(f2::int) + max(f3::int) + max(f4::int) + max(f5::int) + max(f8::int) + max(f10::int) + max(f11::int)) as bigint) as hard_failures,
       cast((max(f6::int) + max(f7::int) + max(f9::int)) as bigint) as soft_warnings, cast(0 as bigint) as passes,
       round((1.0::double - count(*) filter (where {_ANY})::double / count(*)) * 100, 1) as dqi_rows, 0.0::double as dqi_binary
from checks""")
def validate_dqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report row: quality by rows and by batch."""
    rows, compiled = _judged(spark, sf_dir)
    return rules.report(rows, compiled, "lines").select(
        "dataset", "row_count", "flagged_rows", "hard_failures", "soft_warnings", F.col("hard_rule_pass").cast("bigint").alias("passes"),
        "dqi_rows", "dqi_binary")


@query("quarantine_split", "with " + _DEFECTS + """
select case when (f1 or f2 or f3 or f4 or f5 or f8 or f10 or f11) then 'quarantine' else 'promote' end as part, count(*) as row_count,
       cast(sum(allocated) as double) as allocated from checks group by 1""")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a hard rule go to quarantine; soft ones are promoted with their flags."""
    rows, compiled = _judged(spark, sf_dir)
    text = rules.without_text(rules.flagged(rows, compiled))
    clean, broken = rules.split_once(text, labels=rules.hard_labels(compiled))
    amount = F.sum(F.col("allocated").cast("decimal(18,2)")).cast("double").alias("allocated")
    return clean.withColumn("part", F.lit("promote")).unionByName(broken.withColumn("part", F.lit("quarantine"))).groupBy("part").agg(
        F.count("*").alias("row_count"), amount)


@query("duplicate_keys", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, copies from (
  select *, count(*) over (partition by l_orderkey, l_linenumber) as copies from lineitem) where copies > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of repeated keys."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return duplicated_rows(li, ["l_orderkey", "l_linenumber"]).withColumn("_copies", F.col("_copies").cast("bigint")).withColumnRenamed("_copies", "copies")


@query("failure_rows", "with " + _DEFECTS + """
select 'lines' as dataset, 'run-1' as run_id, 'hard validation failed' as reason, 'unique' as rule, count(*) filter (where f5) as failed_count from checks
union all select 'lines', 'run-1', 'hard validation failed', 'between', count(*) filter (where f10) from checks""")
def failure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine entries hold each rule's outcome as JSON; two of them read back."""
    rows, compiled = _judged(spark, sf_dir)
    entries = staging.failure_rows(rules.rule_results(rows, compiled), "lines", "run-1", "hard validation failed")
    parsed = entries.withColumn("r", F.from_json("rule_result", "rule string, failed_count bigint"))
    return parsed.filter(F.col("r.rule").isin("unique", "between")).select("dataset", "run_id", "reason", "r.rule", "r.failed_count")


@query("model_tests", "with " + inputs.GOLD + """
select 'bronze_project_monitoring' as layer, 'not_null' as rule, 'project_id' as "column", 'hard' as severity, count(*) filter (where project_id is null) as failed_count from bronze
union all select 'bronze_project_monitoring', 'not_null', 'last_updated_at', 'hard', count(*) filter (where last_updated_at is null) from bronze
union all select 'bronze_project_monitoring', 'not_null', 'dt', 'hard', count(*) filter (where dt is null) from bronze
union all select 'silver_project_monitoring', 'not_null', 'project_id', 'hard', count(*) filter (where project_id is null) from silver
union all select 'silver_project_monitoring', 'unique', 'project_id', 'hard', count(*) - count(distinct project_id) from silver
union all select 'silver_project_monitoring', 'between', 'budget_utilization_pct', 'soft', count(*) filter (where budget_utilization_pct < 0 or budget_utilization_pct > 100) from silver
union all select 'silver_project_monitoring', 'in_set', 'quality_flag', 'soft', count(*) filter (where quality_flag not in ('pass', 'soft_violation_over_budget', 'soft_violation_invalid_dates')) from silver
union all select 'gold_portfolio_performance', 'between', 'utilization_rate_pct', 'hard', count(*) filter (where utilization_rate_pct < 0 or utilization_rate_pct > 100) from gold""")
def model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of all three layers."""
    b, s = inputs.bronze(spark, sf_dir), inputs.silver(spark, sf_dir)
    names = ("bronze_project_monitoring", "silver_project_monitoring", "gold_portfolio_performance")
    layers = dict(zip(names, (b, s, medallion.portfolio_performance(s))))
    return rules.model_tests({n: medallion.MODEL_TESTS[n] for n in names}, layers).select(
        "layer", "rule", "column", "severity", "failed_count")


@query("gold_gate", "with " + inputs.GOLD + """
select count(*) as row_count, cast(count(*) > 0 as bigint) as success from gold where quarter = (select max(quarter) from gold)""")
def gold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold must hold rows for the newest quarter."""
    g = inputs.gold(spark, sf_dir)
    newest = g.agg(F.max("quarter").alias("q")).scalar()
    return rules.not_empty(g, F.col("quarter") == newest).withColumn("success", F.col("success").cast("bigint"))


# --- configuration tables, derived so that they grow with the data -----------------------------------

def configuration(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as datasets, their order years as schema versions, parts as sources and mappings."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    suppliers = s.agg(F.count("*").alias("n")).scalar()
    owner = (F.col("p_partkey") % suppliers).cast("string")
    source = F.concat(F.lit("source-"), F.col("p_partkey"))
    version = F.explode(F.sequence(F.lit(1), (F.col("s_suppkey") % 3 + 1).cast("int")))
    schemas = s.select("s_suppkey", version.alias("v"))
    return {
        "dataset_registry": s.select(
            F.col("s_suppkey").cast("string").alias("dataset_id"), F.col("s_name").alias("dataset_name"), F.lit("1.0").alias("version"),
            F.lit("").alias("description"), F.when(F.col("s_suppkey") % 10 == 0, "retired").otherwise("active").alias("status"),
            F.lit(None).cast("string").alias("owner")),
        "ingestion_schema": schemas.select(
            F.concat_ws("-", "s_suppkey", "v").alias("schema_id"), F.col("s_suppkey").cast("string").alias("dataset_id"),
            F.col("v").alias("schema_version"), F.lit('[{"name":"p_name"},{"name":"p_size","dtype":"integer","required":true}]').alias("fields"),
            F.lit('["p_name"]').alias("unique_fields"),
            F.when((F.col("v") == 3) & (F.col("s_suppkey") % 2 == 0), "draft").otherwise("active").alias("status")),
        "ingestion_source": p.select(
            source.alias("source_id"), owner.alias("dataset_id"), F.lit("file").alias("source_type"),
            F.to_json(F.struct(F.col("p_brand").alias("agency"))).alias("config"), F.col("p_size").alias("priority"),
            F.when(F.col("p_partkey") % 7 == 0, "paused").otherwise("active").alias("status")),
        "field_mapping": p.filter(F.col("p_partkey") % 4 != 0).select(
            "p_partkey", source.alias("source_id"), F.explode(F.sequence(F.lit(1), (F.col("p_partkey") % 3).cast("int") + 1)).alias("v"),
            owner.alias("o")).select(
            (F.col("p_partkey") * 10 + F.col("v")).alias("mapping_id"), F.concat_ws("-", "o", "v").alias("schema_id"), "source_id",
            F.concat(F.lit("raw "), F.col("v")).alias("raw_field"), F.lit("p_name").alias("canonical_field"), F.lit(None).cast("string").alias("transform")),
        "validation_rule": p.select(
            F.concat(F.lit("rule-"), F.col("p_partkey")).alias("rule_id"), owner.alias("dataset_id"), F.lit("p_size").alias("field_name"),
            F.when(F.col("p_partkey") % 2 == 0, "null_check").otherwise("duplicate_check").alias("rule_type"),
            F.when(F.col("p_size") > 25, "hard").otherwise("soft").alias("severity"), F.lit("{}").alias("rule_config"),
            (F.col("p_partkey") % 5 != 0).alias("active")),
    }


_CONFIG = """
suppliers as (select count(*) as n from supplier),
registry as (select cast(s_suppkey as varchar) as dataset_id, s_name as dataset_name from supplier where s_suppkey % 10 <> 0),
versions as (
  select s_suppkey, unnest(range(1, s_suppkey % 3 + 2)) as v from supplier),
newest as (
  select cast(s_suppkey as varchar) as dataset_id, max(v) as v from versions where not (v = 3 and s_suppkey % 2 = 0) group by 1),
sources as (
  select p_partkey, 'source-' || p_partkey as source_id, cast(p_partkey % (select n from suppliers) as varchar) as dataset_id, p_size as priority
  from part where p_partkey % 7 <> 0)"""


@query("config_resolved_sources", "with " + _CONFIG + """
select dataset_name, cast(n.v as integer) as schema_version, source_id, priority,
       cast(case when p_partkey % 4 <> 0 and n.v <= p_partkey % 3 + 1 then 1 else 0 end as bigint) as mapping_count
from sources s join registry r using (dataset_id) join newest n using (dataset_id)""")
def config_resolved_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active sources of active datasets with the mappings of the newest active schema, none kept as none."""
    out = config_tables.source_mappings(configuration(spark, sf_dir))
    return out.groupBy("dataset_name", "schema_version", "source_id", "priority").agg(F.count("mapping_id").alias("mapping_count"))


@query("rules_from_table", "with " + _CONFIG + """
select dataset_name, case when p_partkey % 2 = 0 then 'not_null' else 'unique' end as kind, case when p_size > 25 then 'hard' else 'soft' end as severity, count(*) as n
from part join registry on dataset_id = cast(p_partkey % (select n from suppliers) as varchar) where p_partkey % 5 <> 0 group by 1, 2, 3""")
def rules_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active stored rules with the check they stand for."""
    kind = F.lit(None).cast("string")
    for stored, (known, _) in config_tables._STORED_KINDS.items():
        kind = F.when(F.col("rule_type") == stored, known).otherwise(kind)
    return config_tables.active_rules(configuration(spark, sf_dir)).groupBy("dataset_name", kind.alias("kind"), "severity").agg(
        F.count("*").alias("n"))


@query("rules_applied_from_contract_table", """
select 'not_null' as rule, 'p_size' as "column", count(*) filter (where p_size is null) as failed_count from part
union all select 'unique', 'p_name', (select coalesce(sum(n), 0)::bigint from (select count(*) as n from part group by p_name having count(*) > 1)) from (select 1)""")
def rules_applied_from_contract_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract read from the tables and applied to parts."""
    tables = configuration(spark, sf_dir)
    name = tables["dataset_registry"].filter(F.col("status") == "active").agg(F.min("dataset_name")).first()[0]
    contract = config_tables.contract_from_tables(tables, name)
    parts = table(spark, sf_dir, "part").select("p_name", F.col("p_size").cast("string").alias("p_size"))
    compiled = [r for r in rules.contract_rules(contract, parts.columns) if r.label in ("not_null:p_size", "unique:p_name")]
    out = {r.label: r for r in compiled}
    return rules.rule_results(parts, list(out.values())).select("rule", "column", "failed_count")


@query("config_insert_absent", """
select s_suppkey as dataset_key, s_name as dataset_name, case when s_suppkey % 2 = 0 then 'kept' else 'added' end as origin from supplier""")
def config_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is already there stay as they are."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("dataset_key"), F.col("s_name").alias("dataset_name"))
    held = s.filter(F.col("dataset_key") % 2 == 0).withColumn("origin", F.lit("kept"))
    return config_tables.insert_absent(held, s.withColumn("origin", F.lit("added")), ["dataset_key"])


@query("config_audit", """
select 'table' as kind, 'source-' || p_partkey as key, case when p_size > 40 then 'active' when p_partkey % 7 = 0 then 'paused' else 'active' end as value,
       cast(case when p_size > 40 then 1 else p_size end as varchar) as priority from part
union all select 'audit', 'source-' || p_partkey, 'UPDATE', '1' from part where p_size > 40""")
def config_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed sources replaced by key, each with an audit row holding its new value."""
    sources = configuration(spark, sf_dir)["ingestion_source"]
    changes = sources.filter(F.col("priority") > 40).withColumns({"priority": F.lit(1), "status": F.lit("active")})
    audit = spark.createDataFrame([], "table_modified string, change_type string, changed_by string, reason string, new_value string, changed_at timestamp_ntz")
    fresh, log = config_tables.updated_with_audit(sources, changes, audit, ["source_id"], "ingestion_source", "admin", "raise", "2026-01-01 00:00:00")
    value = F.from_json("new_value", "source_id string, priority int")
    return fresh.select(F.lit("table").alias("kind"), F.col("source_id").alias("key"), F.col("status").alias("value"), F.col("priority").cast("string").alias("priority")).unionByName(
        log.select(F.lit("audit").alias("kind"), value["source_id"].alias("key"), F.col("change_type").alias("value"), value["priority"].cast("string").alias("priority")))


@query("dataset_name_union", "select s_name as dataset_name from supplier where s_suppkey % 10 <> 0 union select c_name from customer union select s_name from supplier where s_suppkey % 3 = 0")
def dataset_name_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names known to any registry, once each."""
    active = config_tables.active_datasets(configuration(spark, sf_dir))
    others = table(spark, sf_dir, "customer").select(F.col("c_name").alias("dataset_name"))
    third = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 3 == 0).select(F.col("s_name").alias("dataset_name"))
    return config_tables.dataset_names(active, others, third)
