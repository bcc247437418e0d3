"""Contracts kept in five configuration tables.

``dataset_registry, ingestion_schema, ingestion_source, field_mapping, validation_rule``
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.contract import Alias, Contract, RuleSpec, Source, _fields
from assaylake.operators.keys import latest_by


def active_datasets(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["dataset_registry"].filter(F.col("status") == "active").select("dataset_name")


def dataset_names(*registries: DataFrame) -> DataFrame:
    """Names known to any registry, once each."""
    names = registries[0].select("dataset_name")
    for other in registries[1:]:
        names = names.union(other.select("dataset_name"))
    return names.distinct()


def current_schemas(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every active dataset with its highest active schema version."""
    schemas = tables["ingestion_schema"].filter(F.col("status") == "active")
    newest = latest_by(schemas, ["dataset_id"], ["schema_version"], ["schema_id"])
    datasets = tables["dataset_registry"].filter(F.col("status") == "active").select("dataset_id", "dataset_name")
    return datasets.join(newest.drop("status"), "dataset_id")


def source_mappings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every active source with its column mappings, one per row; a source without any keeps one
    row whose mapping is null."""
    resolved = current_schemas(tables).select("dataset_id", "dataset_name", "schema_id", "schema_version")
    sources = tables["ingestion_source"].filter(F.col("status") == "active").drop("status")
    return resolved.join(sources, "dataset_id").join(tables["field_mapping"], ["schema_id", "source_id"], "left")


def active_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    names = tables["dataset_registry"].filter(F.col("status") == "active").select("dataset_id", "dataset_name")
    return tables["validation_rule"].filter(F.col("active")).join(names, "dataset_id")


def _parsed(value, default):
    if value is None or value == "":
        return default
    try:
        return json.loads(value)
    except (TypeError, ValueError):
        return default


# Rule kinds as stored, and what each one checks.
_STORED_KINDS = {
    "null_check": ("not_null", {}),
    "duplicate_check": ("unique", {}),
    "schema_validation": ("schema", {}),
    "budget_utilized_le_allocated": ("pair_at_most", {"other": "budget_allocated_php"}),
    "end_date_after_start_date": ("pair_above", {"other": "start_date"}),
}


def stored_rule(rule_id: str, kind: str, column: str | None, severity: str, config: str | None) -> RuleSpec:
    """A stored rule as a rule the compiler knows."""
    if kind in _STORED_KINDS:
        known, params = _STORED_KINDS[kind]
    else:
        known, params = kind, {}
    return RuleSpec(rule_id, known, column, severity, {**params, **_parsed(config, {})})


def contract_from_tables(tables: Mapping[str, DataFrame], dataset: str) -> Contract:
    """One dataset's contract. Only that dataset's configuration rows reach the driver."""
    found = current_schemas(tables).filter(F.col("dataset_name") == dataset).take(1)
    if not found:
        raise KeyError(f"dataset {dataset!r} has no active registry entry and schema")
    schema = found[0]
    rows = (source_mappings(tables).filter(F.col("dataset_name") == dataset)
            .orderBy("priority", "source_id", "mapping_id").collect())
    found_sources, aliases = {}, {}
    for row in rows:
        found_sources[row["source_id"]] = row
        if row["mapping_id"] is not None:
            aliases.setdefault(row["source_id"], []).append(Alias(row["raw_field"], row["canonical_field"], row["transform"]))
    sources = []
    for source_id, row in found_sources.items():
        options = _parsed(row["config"], {})
        constants = {k: options[k] for k in ("agency", "region") if options.get(k)}
        sources.append(Source(source_id, row["source_type"], constants, options,
                              tuple(aliases.get(source_id, ())), row["priority"]))
    rules = tuple(
        stored_rule(r["rule_id"], r["rule_type"], r["field_name"], r["severity"], r["rule_config"])
        for r in active_rules(tables).filter(F.col("dataset_name") == dataset).orderBy("rule_id").collect()
    )
    return Contract(
        dataset=dataset, fields=_fields(_parsed(schema["fields"], [])),
        unique_fields=tuple(_parsed(schema["unique_fields"], [])), sources=tuple(sources), rules=rules,
        version=str(schema["schema_version"]), origin="tables",
    )


# --- writing contracts into the tables -------------------------------------------------------------

def contract_rows(spark, contract: Contract) -> dict[str, DataFrame]:
    """A contract as rows of the five tables, ready for :func:`seeded`."""
    name, schema_id = contract.dataset, f"{contract.dataset}-1"
    fields = [
        {"name": f.name, "dtype": f.dtype, "required": f.required,
         **({"permissible_values": list(f.allowed)} if f.allowed else {}),
         **({"min": f.minimum} if f.minimum is not None else {})}
        for f in contract.fields
    ]
    mapping = [
        (i, schema_id, s.source_id, a.raw, a.canonical, a.transform)
        for i, (s, a) in enumerate((s, a) for s in contract.sources for a in s.aliases)
    ]
    rows = {
        "dataset_registry": (
            [(name, name, contract.version, contract.description, "active", contract.owner)],
            "dataset_id string, dataset_name string, version string, description string, status string, owner string"),
        "ingestion_schema": (
            [(schema_id, name, 1, json.dumps(fields), json.dumps(list(contract.unique_fields)), "active")],
            "schema_id string, dataset_id string, schema_version int, fields string, unique_fields string, status string"),
        "ingestion_source": (
            [(s.source_id, name, s.channel, json.dumps({**dict(s.options), **dict(s.constants)}), s.priority, "active")
             for s in contract.sources],
            "source_id string, dataset_id string, source_type string, config string, priority int, status string"),
        "field_mapping": (
            mapping,
            "mapping_id bigint, schema_id string, source_id string, raw_field string, canonical_field string, transform string"),
        "validation_rule": (
            [(r.rule_id, name, r.column, r.kind, r.severity, json.dumps(dict(r.params)), True) for r in contract.rules],
            "rule_id string, dataset_id string, field_name string, rule_type string, severity string, rule_config string, active boolean"),
    }
    return {table: spark.createDataFrame(data, schema) for table, (data, schema) in rows.items()}


# The columns that make a configuration row unique.
UNIQUE_KEYS = {
    "dataset_registry": ("dataset_name",),
    "ingestion_schema": ("dataset_id", "schema_version"),
    "ingestion_source": ("source_id",),
    "field_mapping": ("schema_id", "source_id", "raw_field"),
    "validation_rule": ("rule_id",),
}


def insert_absent(table: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """The table with those rows whose key it does not hold yet."""
    return table.unionByName(rows.join(table.select(*keys), list(keys), "left_anti").select(table.columns))


def seeded(tables: Mapping[str, DataFrame], contract: Contract) -> dict[str, DataFrame]:
    """The tables with a contract's rows added where they are absent."""
    spark = tables["dataset_registry"].sparkSession
    rows = contract_rows(spark, contract)
    return {name: insert_absent(tables[name], rows[name], keys) for name, keys in UNIQUE_KEYS.items()}


def updated_with_audit(
    table: DataFrame, changes: DataFrame, audit: DataFrame, keys, section: str, changed_by: str, reason: str, at,
) -> tuple[DataFrame, DataFrame]:
    """Replace rows by key and record each change with its reason and new value."""
    fresh = table.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes.select(table.columns))
    entries = changes.select(
        F.lit(section).alias("table_modified"), F.lit("UPDATE").alias("change_type"),
        F.lit(changed_by).alias("changed_by"), F.lit(reason).alias("reason"),
        F.to_json(F.struct(*[F.col(c) for c in table.columns])).alias("new_value"),
        F.lit(at).cast("timestamp_ntz").alias("changed_at"))
    return fresh, audit.unionByName(entries)
