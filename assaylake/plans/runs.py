"""Whole runs: a tabular dataset from its channels to Gold, a map layer from features to serving."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.contract import Contract
from assaylake.functions.crypto import KeyRing
from assaylake.operators import canonical, layers, pii, rules
from assaylake.plans import medallion
from assaylake.sinks import logs, staging, versions


class BatchRejected(ValueError):
    """Hard rules failed. The batch is in quarantine, nothing was promoted."""

    def __init__(self, dataset: str, folder: str, failed: list[str]) -> None:
        super().__init__(f"{dataset}: hard rules failed {failed}; batch kept in {folder}")
        self.folder = folder
        self.failed = failed


@dataclass(frozen=True)
class DatasetRun:
    report: dict[str, Any]
    results: DataFrame
    manifests: DataFrame
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    tests: DataFrame = field(repr=False)
    vault: DataFrame | None = None  # of a run under a privacy policy
    findings: DataFrame | None = None


Silver = Callable[[DataFrame, SparkSession], DataFrame]
Gold = Callable[[DataFrame], DataFrame]
_MODELS: dict[str, tuple[Silver, Gold]] = {
    "project_monitoring": (
        lambda bronze, spark: medallion.silver_projects(bronze, medallion.region_dimension(spark)),
        medallion.portfolio_performance),
    "rd_equipment_inventory": (
        lambda bronze, spark: medallion.silver_equipment(bronze), medallion.equipment_summary),
}


def register_models(dataset: str, silver: Silver, gold: Gold) -> None:
    """Silver and Gold of a further dataset."""
    _MODELS[dataset] = (silver, gold)


_TESTS = {
    "project_monitoring": ("bronze_project_monitoring", "silver_project_monitoring", "gold_portfolio_performance"),
    "rd_equipment_inventory": ("bronze_rd_equipment_inventory", "silver_rd_equipment_inventory", "gold_equipment_summary"),
}


def validate_batch(staged: DataFrame, contract: Contract, strict: bool = False) -> tuple[DataFrame, DataFrame, list]:
    """Report, rule results and compiled rules of staged rows."""
    canonical.check_columns(staged, contract)
    rows, compiled = rules.judged(canonical.only_canonical(staged, contract), contract, strict)
    key = contract.unique_fields[0] if contract.unique_fields else None
    return rules.report(rows, compiled, contract.dataset), rules.rule_results(rows, compiled, key), compiled


def run_dataset(
    spark: SparkSession, contract: Contract, channels: Mapping[str, DataFrame], root: str, run_id: str | None = None,
    run_date: str | None = None, strict: bool = False, policy: pii.Policy | None = None, keys: KeyRing | None = None,
) -> DatasetRun:
    """Stage, validate, promote and build one dataset from the raw rows of its channels.

    Under a privacy policy rows are validated as they come in and protected before anything is written: no table, landing
    or quarantine folder holds readable values. The vault is published together with Bronze.
    """
    run_id = run_id or staging.new_batch_id(contract.dataset)
    stamp = staging.now_text()
    run_date = run_date or stamp[:10]
    execution, runlog = uuid.uuid4().hex, os.path.join(root, "run_log")
    logs.append_run(logs.run_entry(spark, execution, contract.dataset, run_id, run_id, "running"), runlog)
    try:
        guard = None
        if policy is not None:
            # read twice, once to be judged and once to be protected; nothing readable is written
            incoming = canonical.union_channels([rows.withColumn("_source_id", F.lit(s)) for s, rows in channels.items()])
            report, results, _ = validate_batch(incoming.drop("_source_id"), contract, strict)
            guard = pii.protect(incoming, policy, contract.unique_fields[0], keys, check_ids=False).stored(
                os.path.join(root, "protected", contract.dataset, uuid.uuid4().hex))
            channels = {s: guard.serving.filter(F.col("_source_id") == s).drop("_source_id") for s in channels}
        ready, manifests = _stage(spark, contract, channels, root, run_id, run_date)
        if policy is None:
            report, results, _ = validate_batch(ready.drop("_source_id"), contract, strict)
        summary = report.first().asDict()
        if not summary["hard_rule_pass"]:
            failed = [f"{r['rule']}:{r['column']}" for r in rules.failed_rules(results).collect()]
            folder = staging.quarantined(ready, root, contract.dataset, run_id, "hard validation failed", results)
            raise BatchRejected(contract.dataset, folder, failed)
        table = os.path.join(root, "staging", f"{contract.dataset}_raw")
        staging.append_staging(staging.stamped(ready, contract, run_id, F.col("_source_id"), stamp), table)
        run = _build(spark, contract, table, root, run_id, summary, results, manifests, guard)
    except Exception as error:
        logs.append_run(logs.run_entry(spark, execution, contract.dataset, run_id, run_id, "failed", type(error).__name__), runlog)
        raise
    logs.append_run(logs.run_entry(
        spark, execution, contract.dataset, run_id, run_id, "success", rows_received=summary["row_count"],
        hard_failures=summary["hard_failures"], soft_warnings=summary["soft_warnings"]), runlog)
    return run


def _stage(spark, contract, channels, root, run_id, run_date) -> tuple[DataFrame, DataFrame]:
    frames, manifests = [], []
    for source_id, rows in channels.items():
        source = contract.source(source_id)
        agency = source.constants.get("agency", canonical.UNKNOWN)
        path = staging.write_staged(rows, os.path.join(root, "landing"), contract.dataset, source_id, agency, run_date, run_id)
        kept = spark.read.parquet(path)
        frames.append(kept.withColumn("_source_id", F.lit(source_id)))
        origin = F.col("_source_object") if "_source_object" in kept.columns else F.lit(source.channel)
        manifests.append(staging.manifest(kept, contract.dataset, run_id, F.lit(agency), F.lit(source_id), origin, F.lit(path)))
    return canonical.union_channels(frames), reduce(DataFrame.unionByName, manifests)


def _build(spark, contract, table, root, run_id, summary, results, manifests, guard) -> DatasetRun:
    if contract.dataset not in _MODELS:
        raise KeyError(f"no models for dataset {contract.dataset!r}; register them with register_models")
    store = versions.VersionedTables(spark, os.path.join(root, "tables"))
    names = {layer: f"{layer}_{contract.dataset}" for layer in ("bronze", "silver", "gold")}
    bronze = medallion.bronze(staging.read_staging(spark, table), contract, run_id)
    vault_name = f"{names['bronze']}_vault"
    if guard is None:
        store.replace(names["bronze"], bronze, run_id)
    else:
        sealed = guard.vault.withColumn("batch_id", F.lit(run_id))
        held = store.read(vault_name).filter(F.col("batch_id") != run_id) if store.current(vault_name) else sealed.limit(0)
        store.replace_all({names["bronze"]: bronze, vault_name: held.unionByName(sealed)}, run_id)
    silver, gold = _MODELS[contract.dataset]
    store.replace(names["silver"], silver(store.read(names["bronze"]), spark), run_id)
    store.replace(names["gold"], gold(store.read(names["silver"])), run_id)
    built = {layer: store.read(name) for layer, name in names.items()}
    checks = _TESTS.get(contract.dataset, ())
    tests = rules.model_tests({n: medallion.MODEL_TESTS[n] for n in checks}, dict(zip(checks, built.values())))
    hidden = {} if guard is None else {"vault": store.read(vault_name), "findings": guard.findings}
    return DatasetRun(summary, results, manifests, tests=tests, **built, **hidden)


# --- layers ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class LayerRun:
    report: dict[str, Any]
    loaded: dict[str, Any]
    serving: DataFrame
    view: DataFrame
    vault: DataFrame
    findings: DataFrame


def run_layer(spark: SparkSession, features: DataFrame, config: Mapping[str, Any], keys: KeyRing, root: str,
              run_id: str, at) -> LayerRun:
    """Validate, protect, standardize, archive and load one map layer.

    Readable personal data is never written: quarantine keeps protected rows only.
    """
    layers.checked_layer(config)
    layer, key = config["layer"], config["unique_key"]
    report, results = layers.validate_layer(features, config)
    summary = report.first().asDict()
    policy = pii.policy_from(config.get("pii"))
    if not summary["hard_rule_pass"]:
        # without its key a layer is protected under a number of its own, so that its attributes are kept
        named = features if key in features.columns else features.withColumn(key, F.monotonically_increasing_id().cast("string"))
        rows = pii.protect(named, _held_columns(policy, named), key, keys, check_ids=False).serving
        failed = [f"{r['rule']}:{r['column']}" for r in rules.failed_rules(results).collect()]
        # sample ids are keys, not personal data: the key column may not be a privacy column
        folder = staging.quarantined(rows, root, layer, run_id, "hard validation failed", results)
        raise BatchRejected(layer, folder, failed)
    guard = pii.protect(features, policy, key, keys).stored(os.path.join(root, "protected", layer, uuid.uuid4().hex))
    ready = layers.standardized(guard.serving, config, run_id, at)
    archive = os.path.join(root, "archive")
    versions.archive_layer(ready, archive, layer, run_id)
    versions.archive_layer(guard.vault, archive, layer, run_id, name="vault")
    store = versions.VersionedTables(spark, os.path.join(root, "tables"))
    loaded = versions.load_layer(store, ready, guard.vault, layer, run_id)
    serving = store.read(layer)
    exposed = layers.exposed_columns(config) or [a["name"] for a in config["attributes"] if a["name"] not in policy.columns]
    view = versions.serving_view(serving, exposed, list(policy.columns))
    return LayerRun(summary, loaded, serving, view, store.read(f"{layer}_vault"), guard.findings)


def _held_columns(policy: pii.Policy, df: DataFrame) -> pii.Policy:
    """The policy for the columns that are there; a batch is often rejected because some are not."""
    return replace(policy, columns={c: t for c, t in policy.columns.items() if c in df.columns})


def layer_checks(serving: DataFrame, view: DataFrame, vault: DataFrame, config: Mapping[str, Any],
                 expected_rows: int, expected_vault_rows: int, known: list[str]) -> DataFrame:
    """What must hold after a load, one row per check: rows, vault rows, exposed columns, no leaks."""
    spark = serving.sparkSession
    exposed = layers.exposed_columns(config) or []
    text = [c for c in pii.text_columns(serving) if c not in (config.get("pii") or {}).get("skip_columns", ())]
    only_exposed = [c for c in view.columns if c != "geom"] == list(exposed)
    counts = serving.agg((F.count("*") == expected_rows).alias("passed")).withColumn("check", F.lit("serving_rows"))
    sealed = vault.agg((F.count("*") == expected_vault_rows).alias("passed")).withColumn("check", F.lit("vault_rows"))
    cipher = vault.agg(F.coalesce(F.bool_and(F.col("ciphertext").startswith("vault:v")), F.lit(True)).alias("passed")).withColumn(
        "check", F.lit("vault_is_ciphertext"))
    columns = spark.createDataFrame([(only_exposed, "exposed_columns")], "passed boolean, check string")
    leaked = pii.leaks(serving, known, text).agg((F.coalesce(F.sum("cells"), F.lit(0)) == 0).alias("passed")).withColumn(
        "check", F.lit("no_known_value"))
    scanned = pii.rescanned(serving, [c for c in text if c != config["unique_key"]]).agg(
        (F.count("*") == 0).alias("passed")).withColumn("check", F.lit("second_scan_is_clean"))
    return reduce(lambda a, b: a.unionByName(b), [counts, sealed, cipher, columns, leaked, scanned]).select("check", "passed")
