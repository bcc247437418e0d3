import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assaylake.catalogue import PROJECT_MONITORING, RD_EQUIPMENT_INVENTORY
from assaylake.operators import canonical, cdc, joins, pii, rules
from assaylake.functions.crypto import KeyRing
from assaylake.plans.runs import BatchRejected, run_dataset, validate_batch
from assaylake.sinks import logs
from assaylake.sources import files, records
from tests.fixtures import BAD, CSV_COLUMNS, GOOD_A, GOOD_B, write_csv


def file_channel(spark, folder):
    raw = files.read_csv_folder(spark, str(folder), CSV_COLUMNS, "*.csv")
    return canonical.canonicalized(raw, PROJECT_MONITORING, PROJECT_MONITORING.source("regional_files"), keep=["_source_object"])


def api_channel(spark, folder):
    rows = [{"project_id": f"A-{i}", "agency": "PCHRD", "region": "R4A", "program_area": "Health", "project_title": "T",
             "principal_investigator": "Dr. X", "start_date": "2026-01-15", "end_date": "2026-12-15",
             "budget_allocated_php": 1000000, "budget_utilized_php": 250000, "status": "Ongoing", "funding_source": "GAA"}
            for i in (1, 2)]
    path = folder / "page.json"
    path.write_text(json.dumps({"data": {"records": rows}}, indent=2), encoding="utf-8")
    raw = records.read_json_payloads(spark, str(path), PROJECT_MONITORING.names)
    return canonical.canonicalized(raw, PROJECT_MONITORING, PROJECT_MONITORING.source("monitoring_api"))


def test_good_batch_reaches_gold(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", GOOD_A)
    write_csv(tmp_path / "in" / "b.csv", GOOD_B)
    root = str(tmp_path / "lake")
    run = run_dataset(spark, PROJECT_MONITORING, {
        "regional_files": file_channel(spark, tmp_path / "in"), "monitoring_api": api_channel(spark, tmp_path)}, root, "run-1")
    assert run.report["row_count"] == 7 and run.report["hard_rule_pass"] and run.report["dqi_rows"] == 100.0
    assert run.bronze.count() == 7 and run.silver.count() == 7
    assert {r["row_count"] for r in run.manifests.collect()} == {2, 3}
    row = run.silver.filter("project_id = 'Q-11'").first()
    assert (row["region_name"], str(row["budget_allocated_php"]), str(row["start_date"])) == ("CALABARZON", "2250000.00", "2024-04-03")
    assert float(row["budget_utilization_pct"]) == 70.0
    assert run.silver.filter("project_id = 'Q-15'").first()["start_date"].isoformat() == "2026-05-06"
    gold = {(r["program_area"], str(r["quarter"]), r["status"]): r for r in run.gold.collect()}
    health = gold[("Health", "2026-01-01", "Ongoing")]
    assert health["project_count"] == 3 and float(health["utilization_rate_pct"]) == round(800000 / 4400000 * 100, 1)
    assert all(r["success"] for r in run.tests.collect())
    # a second run appends to bronze and silver still has one row per project
    again = run_dataset(spark, PROJECT_MONITORING, {"regional_files": file_channel(spark, tmp_path / "in")}, root, "run-2")
    assert again.bronze.count() == 12 and again.silver.count() == 7
    log = logs.latest_runs(logs.run_log(spark, f"{root}/run_log"), "run_id")
    assert {(r["run_id"], r["status"]) for r in log.collect()} == {("run-1", "success"), ("run-2", "success")}


def test_bad_batch_is_quarantined(spark, tmp_path):
    write_csv(tmp_path / "in" / "bad.csv", BAD)
    root = str(tmp_path / "lake")
    with pytest.raises(BatchRejected) as caught:
        run_dataset(spark, PROJECT_MONITORING, {"regional_files": file_channel(spark, tmp_path / "in")}, root, "bad")
    assert set(caught.value.failed) == {"unique:project_id", "not_null:project_title", "pair_at_least:budget_allocated_php"}
    assert spark.read.parquet(caught.value.folder + "/rows").count() == 6
    assert not (tmp_path / "lake" / "staging").exists()
    assert [r["status"] for r in logs.latest_runs(logs.run_log(spark, f"{root}/run_log")).collect()] == ["failed"]


def test_bad_batch_row_by_row(spark, tmp_path):
    write_csv(tmp_path / "in" / "bad.csv", BAD)
    staged = file_channel(spark, tmp_path / "in")
    report, results, compiled = validate_batch(staged, PROJECT_MONITORING)
    summary = report.first()
    assert (summary["row_count"], summary["flagged_rows"], summary["dqi_rows"], summary["dqi_binary"]) == (6, 5, 16.7, 0.0)
    by_rule = {(r["rule"], r["column"]): r for r in results.collect()}
    assert by_rule[("unique", "project_id")]["failed_count"] == 2
    assert by_rule[("unique", "project_id")]["sample_ids"] == ["D-23", "D-23"]
    assert by_rule[("pair_above", "end_date")]["sample_ids"] == ["D-21"]
    assert by_rule[("pair_above", "end_date")]["severity"] == "soft"
    strict = validate_batch(staged, PROJECT_MONITORING, strict=True)[1]
    assert {r["severity"] for r in strict.collect()} == {"hard"}
    flagged = rules.flagged(*rules.judged(canonical.only_canonical(staged, PROJECT_MONITORING), PROJECT_MONITORING))
    clean, broken = rules.split(flagged)
    assert [r["project_id"] for r in clean.collect()] == ["D-22"] and broken.count() == 5


def test_private_names_are_hidden_before_promotion(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", GOOD_A)
    policy = pii.policy_from({"scan": "declared_only", "columns": {"principal_investigator": {"serving": "pseudonymize"}}})
    keys = KeyRing(spark, b"hmac", {1: b"0123456789abcdef"})
    run = run_dataset(spark, PROJECT_MONITORING, {"regional_files": file_channel(spark, tmp_path / "in")},
                      str(tmp_path / "lake"), "p", policy=policy, keys=keys)
    names = {r[0] for r in run.bronze.select("principal_investigator").collect()}
    assert len(names) == 3 and all(n.startswith("vault:v1:") for n in names)
    # what was hidden can be revealed, and nothing readable was written anywhere
    assert {r["value"] for r in pii.revealed(run.vault, keys).collect()} == {"Dr. N. Salonga", "Dr. P. Quiambao", "Dr. R. Ferrer"}
    assert {(r["column"], r["entity"], r["count"]) for r in run.findings.collect()} >= {("principal_investigator", "declared", 3)}
    held = [spark.read.parquet(str(p)).toPandas().to_json() for p in (tmp_path / "lake").rglob("*.parquet")]
    assert len(held) > 5 and not [n for n in ("Salonga", "Quiambao", "Ferrer") if any(n in text for text in held)]


def test_equipment_from_two_tables(spark, tmp_path):
    equipment = spark.createDataFrame(
        [("E1", "PCR", "Laboratory", "2024-06-10", "1,250,000.00", "Serviceable"),
         ("E2", "Drone", "Field Survey", "2025-01-22", "480,000.00", "Needs Repair"),
         ("E3", "GIS", "ICT", "2023-11-05", "150,000.00", "Serviceable")],
        "equip_id string, equip_name string, category string, acq_date string, acq_cost_php string, status string")
    assigned = spark.createDataFrame([("E1", "J. Cruz", "Central", "2024-06-15"), ("E2", "A. Reyes", "Bicol", "2024-01-25")],
                                     "equip_id string, custodian string, office string, assign_date string")
    source = RD_EQUIPMENT_INVENTORY.source("equipment_registry")
    rows = canonical.canonicalized(joins.join_tables([equipment, assigned], "equip_id"), RD_EQUIPMENT_INVENTORY, source)
    run = run_dataset(spark, RD_EQUIPMENT_INVENTORY, {"equipment_registry": rows}, str(tmp_path), "e1")
    flags = {r["equipment_id"]: r["quality_flag"] for r in run.silver.collect()}
    assert flags == {"E1": "pass", "E2": "soft_violation_assignment_before_acquisition", "E3": "pass"}
    assert run.gold.count() == 3 and all(r["success"] for r in run.tests.collect())
    with pytest.raises(canonical.ColumnMismatch):
        joins.join_tables([equipment, assigned.withColumn("status", F.lit("x"))], "equip_id")


ROW = {n: None for n in PROJECT_MONITORING.names}


def _event(op, key, at, image="after", **extra):
    row = {**ROW, "project_id": key, "agency": "PCAARRD", "region": "NCR", "project_title": f"{key}@{at}", "start_date": "20802"}
    body = {"op": op, image: row, "source": {"table": "projects"}, "ts_ms": at, **extra}
    return json.dumps({k: v for k, v in body.items() if v is not None})


def test_change_channel(spark):
    lines = [
        _event("c", "K1", 1), _event("u", "K1", 3), _event("u", "K1", 2), _event("c", "K2", 1),
        _event("d", "K2", 5, "before"), _event(None, "K3", 1), _event("r", "K4", 2),
        json.dumps({"operation": "insert", "data": {**ROW, "project_id": "K5"}, "table": "t", "timestamp": 9}),
        json.dumps({**ROW, "project_id": "K6"}), None, "",
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    events = records.parse_changes(raw, PROJECT_MONITORING.names)
    out = {r["project_id"]: r for r in cdc.canonical_changes(events, PROJECT_MONITORING, PROJECT_MONITORING.source("project_changes")).collect()}
    assert set(out) == {"K1", "K3", "K4", "K5", "K6"}
    assert out["K1"]["project_title"] == "K1@3" and out["K1"]["start_date"] == "2026-12-15"
    assert out["K1"]["agency"] == "PCHRD" and out["K3"]["_cdc_operation"] == "u" and out["K5"]["_source_table"] == "t"
    own = cdc.canonical_changes(events, PROJECT_MONITORING, PROJECT_MONITORING.source("project_changes"), "row_first")
    assert own.filter("project_id = 'K1'").first()["agency"] == "PCAARRD"
    bad = records.parse_changes(spark.createDataFrame([(_event("x", "K1", 1),)], "value string"), PROJECT_MONITORING.names)
    with pytest.raises(Exception, match="unsupported change operation"):
        cdc.change_rows(bad, PROJECT_MONITORING.names).collect()
