"""Catalog records as tables: one row per dataset and layer, one per field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.contract import Contract
from assaylake.functions.text import slug

# Tags by treatment, and types by declared dtype.
TREATMENT_TAGS = {
    "pseudonymize": "pii_pseudonymized", "mask": "pii_masked", "mask_last3": "pii_masked",
    "replace_in_text": "pii_text_redacted", "redact": "pii_redacted",
}
CATALOG_TYPES = {"string": "string", "float": "number", "integer": "number", "date": "date", "boolean": "boolean"}
STAGE_SCHEMAS = {"raw_ingested": "staging", "bronze": "bronze", "silver": "silver", "gold": "gold"}


def column_tags(findings: DataFrame) -> DataFrame:
    """One tag per protected column; a declared treatment wins over a detected one."""
    tag: Column = F.lit(None).cast("string")
    for treatment, name in TREATMENT_TAGS.items():
        tag = F.when(F.col("treatment") == treatment, F.lit(name)).otherwise(tag)
    return findings.withColumn("tag", tag).filter(F.col("tag").isNotNull()).groupBy("column").agg(
        F.max_by("tag", F.struct(F.col("declared"), F.col("tag"))).alias("tag"))


def dataset_entry(report: DataFrame, dataset: str, stage: str, owner: str, classification: str, schema_ref: str,
                  registered_at: str, table: str | None = None) -> DataFrame:
    """One catalog row for a finished layer, from its validation report."""
    rules = F.struct("hard_failures", "soft_warnings", "hard_rule_pass")
    return report.select(
        F.lit(f"{STAGE_SCHEMAS.get(stage, 'default')}.{table or dataset}").alias("name"),
        F.lit(f"Dataset {dataset}").alias("description"), F.lit(stage).alias("pipeline_stage"),
        slug(F.lit(owner)).alias("owner"), F.array(slug(F.lit(classification))).alias("tags"),
        F.lit(schema_ref).alias("schema_ref"), F.col("dqi_rows").alias("data_quality_index"), "row_count",
        F.to_json(rules).alias("rule_summary"), F.lit(registered_at).alias("registered_at"))


def field_entries(spark, contract: Contract, stage: str) -> DataFrame:
    """One row per declared field."""
    rows = [(contract.dataset, stage, i, f.name, CATALOG_TYPES.get(f.dtype, "string"), f.dtype, f.description)
            for i, f in enumerate(contract.fields)]
    return spark.createDataFrame(rows, "dataset string, stage string, position int, field string, type string, "
                                       "native_type string, description string")


def schema_entries(df: DataFrame, name: str) -> DataFrame:
    """One row per column of any table."""
    rows = [(name, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, position int, field string, native_type string, nullable boolean")


def layer_entry(report: DataFrame, findings: DataFrame, config: dict, owner: str, classification: str,
                batch_id: str, registered_at: str) -> DataFrame:
    """One catalog row for a map layer, with what was protected and how often it was found."""
    tags = column_tags(findings).agg(F.array_sort(F.collect_list("column")).alias("protected"))
    found = findings.filter(F.col("entity") != "declared").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct(F.concat_ws(".", "column", "entity"), F.col("count")))))).alias("found"))
    protected, counts = tags.scalar(), found.scalar()
    return report.select(
        F.lit(config["layer"]).alias("layer"), F.lit(config["geometry_type"]).alias("geometry_type"),
        F.lit(config["target_crs"]).alias("crs"), F.lit(batch_id).alias("batch_id"), "row_count",
        F.col("dqi_rows").alias("data_quality_index"), slug(F.lit(owner)).alias("owner"),
        F.when(F.size(protected) > 0, F.array(slug(F.lit(classification)), F.lit("contains_pii")))
        .otherwise(F.array(slug(F.lit(classification)))).alias("tags"),
        protected.alias("pii_columns"), counts.alias("pii_findings"),
        F.to_json(F.struct("hard_failures", "soft_warnings", "hard_rule_pass")).alias("rule_summary"),
        F.lit(registered_at).alias("registered_at"))


def layer_fields(spark, config: dict, tags: DataFrame, extra: Sequence[str] = ("_batch_id", "_ingested_at")) -> DataFrame:
    """One row per column of a layer with its privacy tag."""
    shape = f"geometry({config['geometry_type']},4326)"
    names = [(a["name"], "text") for a in config["attributes"]] + [("geom", shape)] + [(n, "text") for n in extra]
    fields = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate(names)], "position int, field string, native_type string")
    return fields.join(tags.select(F.col("column").alias("field"), "tag"), "field", "left")
