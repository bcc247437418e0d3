import json

import pytest
import yaml
from pyspark.sql import functions as F

from assaylake.catalogue import CONTRACTS, PROJECT_MONITORING, RD_EQUIPMENT_INVENTORY
from assaylake.contract import Contract, ContractRegistry, Field, RuleSpec, contract_from_mapping
from assaylake.functions import text, transforms
from assaylake.operators import canonical, profile, rules
from assaylake.plans.medallion import layer_table
from assaylake.sinks import catalog, logs, staging
from assaylake.sources import config_tables, files, records, tables
from tests.fixtures import CSV_COLUMNS, GOOD_A, write_csv

SCHEMA = {
    "dataset": "things", "version": "2.0",
    "canonical_schema": {"unique_fields": ["id"], "fields": [
        {"name": "id", "dtype": "string", "required": True}, {"name": "agency", "permissible_values": ["A", "B"]},
        {"name": "cost", "dtype": "float", "min": 0}]},
    "sources": [{"source_id": "drop", "channel": "file", "agency": "A", "submitted_by": "x"}, {"source_id": "api", "channel": "api"}],
}
ALIASING = {"sources": [{"source_id": "drop", "aliases": [
    {"source_field": "ID", "canonical_field": "id"}, {"source_field": "Cost", "canonical_field": "cost", "transform": transforms.CURRENCY_TO_FLOAT}]}]}
QUALITY = {"on_failure": {"soft_rules": ["permissible_values"]}}


@pytest.fixture
def empty_tables(spark):
    return {n: df.limit(0) for n, df in config_tables.contract_rows(spark, PROJECT_MONITORING).items()}


def test_yaml_contract(tmp_path):
    (tmp_path / "schema_things.yaml").write_text(yaml.safe_dump(SCHEMA))
    (tmp_path / "column_aliasing.yaml").write_text(yaml.safe_dump(ALIASING))
    (tmp_path / "common_quality_rules.yaml").write_text(yaml.safe_dump(QUALITY))
    registry = ContractRegistry(tmp_path)
    c = registry.get("things")
    assert registry.names() == ["things"] and c.version == "2.0" and c.origin == "yaml"
    assert c.source("drop").constants == {"agency": "A"} and c.source("drop").aliases[1].transform == transforms.CURRENCY_TO_FLOAT
    assert c.source("api").aliases == () and registry.get("things") is c
    registry.clear()
    assert registry.get("things") is not c
    with pytest.raises(FileNotFoundError):
        registry.get("other")
    with pytest.raises(KeyError):
        c.source("none")
    with pytest.raises(ValueError):
        Field("x", "blob")
    with pytest.raises(ValueError):
        RuleSpec("x", "unique", severity="medium")


def test_contract_from_tables(spark, empty_tables, tmp_path):
    held = config_tables.seeded(config_tables.seeded(empty_tables, PROJECT_MONITORING), RD_EQUIPMENT_INVENTORY)
    held = config_tables.seeded(held, PROJECT_MONITORING)  # nothing is added twice
    assert held["field_mapping"].count() == sum(len(s.aliases) for c in CONTRACTS.values() for s in c.sources)
    got = config_tables.contract_from_tables(held, "project_monitoring")
    assert got.fields == PROJECT_MONITORING.fields and got.unique_fields == ("project_id",)
    assert [s.source_id for s in got.sources] == ["monitoring_api", "regional_files", "project_changes"]
    assert got.source("regional_files").aliases == PROJECT_MONITORING.source("regional_files").aliases
    assert got.source("monitoring_api").aliases == () and {r.rule_id for r in got.rules} == {r.rule_id for r in PROJECT_MONITORING.rules}
    registry = ContractRegistry(tmp_path, held)
    assert registry.get("rd_equipment_inventory").origin == "tables" and registry.names() == sorted(CONTRACTS)
    (tmp_path / "schema_things.yaml").write_text(yaml.safe_dump(SCHEMA))
    assert registry.get("things").origin == "yaml"  # the tables do not know it
    stored = config_tables.stored_rule("r", "budget_utilized_le_allocated", "spent", "hard", '{"other": "given"}')
    assert stored.kind == "pair_at_most" and stored.params == {"other": "given"}


def test_transforms(spark):
    df = spark.createDataFrame([(c,) for c in ["10/01/2025", " 2/1/2026 ", "2026-01-05", "13/45/2025", "", "  ", None, "soon "]], "t string")
    out = [r[0] for r in df.select(transforms.transformed(F.col("t"), transforms.DATE_US_TO_ISO)).collect()]
    assert out == ["2025-10-01", "2026-02-01", "2026-01-05", "13/45/2025", None, None, None, "soon"]
    money = spark.createDataFrame([(c,) for c in ["5,000,000.00", "Php 1.5", "-3", "(1,000)", "-", "", None, "abc"]], "t string")
    assert [r[0] for r in money.select(text.currency_to_double(F.col("t"))).collect()] == [5e6, 1.5, -3.0, 1000.0, None, None, None, None]
    with pytest.raises(KeyError):
        transforms.transformed(F.col("t"), "no such transform")
    transforms.register_transform("upper", F.upper)
    assert df.select(transforms.transformed(F.lit("a"), "upper")).first()[0] == "A"
    assert df.select(transforms.transformed(F.lit("a"), None)).first()[0] == "a"


def test_scalars(spark):
    one = spark.range(1)
    assert one.select(text.iso_to_timestamp(F.lit("2026-01-02T03:04:05.678901+08:00"))).first()[0].isoformat() == "2026-01-02T03:04:05.678901"
    assert one.select(text.iso_to_timestamp(F.lit("x"))).first()[0] is None
    assert one.select(text.epoch_days_to_date(F.lit("20802"))).first()[0].isoformat() == "2026-12-15"
    assert one.select(text.epoch_days_to_date(F.lit("-1"))).first()[0].isoformat() == "1969-12-31"
    assert one.select(text.quarter_label(F.lit("2026-08-01").cast("date"))).first()[0] == "2026-Q3"
    assert one.select(text.quarter_start(F.lit("2026-08-01").cast("date"))).first()[0].isoformat() == "2026-07-01"
    assert text.safe_id_text("run:1+0/x") == "run_1_0_x" and one.select(text.safe_id(F.lit("run:1+0"))).first()[0] == "run_1_0"
    assert one.select(text.slug(F.lit("Project & Knowledge"))).first()[0] == "project_and_knowledge"
    assert text.checked_name("a_b1") == "a_b1" and layer_table("bronze", "t") == "bronze.t"
    with pytest.raises(ValueError):
        text.checked_name("A b")
    assert one.select(text.json_or_default(F.lit("{bad"), "a int", F.struct(F.lit(7).alias("a")))["a"]).first()[0] in (None, 7)
    assert staging.new_batch_id("d").startswith("d-")


def test_csv_text_rules(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,NA\n2,""\n3,\n4,"a ""quoted"", comma"\n5,  spaced \n', encoding="utf-8")
    got = {r["k"]: r["v"] for r in files.read_csv_folder(spark, str(tmp_path), ["k", "v"]).collect()}
    assert got == {"1": "NA", "2": None, "3": None, "4": 'a "quoted", comma', "5": "  spaced "}
    assert files.read_csv_folder(spark, str(tmp_path), ["k", "v"]).select(files.SOURCE_OBJECT).first()[0].endswith("a.csv")
    with pytest.raises(files.NoInputFiles):
        files.read_csv_folder(spark, str(tmp_path), ["k", "v"], "*.txt")
    newest = files.newest_file(files.list_files(spark, str(tmp_path), "*.csv")).first()
    assert newest["path"].endswith("a.csv") and newest["other_candidates"] == 0
    assert len(files.file_digests(spark, str(tmp_path), "*.csv").first()["sha256"]) == 64


def test_channels(spark, tmp_path):
    write_csv(tmp_path / "a.csv", GOOD_A)
    raw = files.read_csv_folder(spark, str(tmp_path), CSV_COLUMNS)
    with pytest.raises(canonical.ColumnMismatch):
        canonical.aliased(raw.drop("Proj_ID"), PROJECT_MONITORING.source("regional_files").aliases)
    with pytest.raises(canonical.ColumnMismatch):
        canonical.identity(raw, PROJECT_MONITORING)
    with pytest.raises(canonical.ColumnMismatch):
        canonical.check_columns(raw, PROJECT_MONITORING)
    no_region = canonical.canonicalized(raw, Contract("x", (Field("project_id"), Field("region"))), PROJECT_MONITORING.source("regional_files"))
    assert no_region.first()["region"] == "R4A"
    assert canonical.with_constants(raw.select("Proj_ID"), Contract("x", (Field("region"),)), {}).first()["region"] == "unknown"
    log = spark.createDataFrame([(json.dumps({"type": "RECORD", "record": {"data": {"a": 1, "b": "x"}}}),), ("INFO start",), (json.dumps({"type": "LOG"}),)], "value string")
    assert [tuple(r) for r in records.protocol_records(log, ["a", "b"]).collect()] == [("1", "x")]


def test_empty_channel_and_file_partitions(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", GOOD_A)
    write_csv(tmp_path / "in" / "b.csv", GOOD_A[:1])
    raw = files.read_csv_folder(spark, str(tmp_path / "in"), CSV_COLUMNS)
    rows = canonical.canonicalized(raw, PROJECT_MONITORING, PROJECT_MONITORING.source("regional_files"), [files.SOURCE_OBJECT])
    path = staging.write_staged(rows, str(tmp_path / "out"), "d", "s", "A", "2026-01-01", "b", by_file=True)
    per_file = spark.read.parquet(path).groupBy(files.SOURCE_OBJECT).count()
    assert sorted(r["count"] for r in per_file.collect()) == [1, 3]
    assert records.required(rows, "files") is rows
    with pytest.raises(records.NoRecords):
        records.required(rows.limit(0), "files")


def test_staging_table_in_the_catalog(spark):
    name = "staging_things_raw"
    staging.create_staging_table(spark, name, PROJECT_MONITORING)
    staging.create_staging_table(spark, name, PROJECT_MONITORING)
    assert spark.table(name).columns == [*PROJECT_MONITORING.names, *staging.STAGING_COLUMNS]
    spark.sql(f"DROP TABLE {name}")


def test_staging_and_logs(spark, root):
    df = spark.createDataFrame([("1", ""), ("2", "x")], "id string, agency string")
    contract = contract_from_mapping(SCHEMA, ALIASING, QUALITY)
    rows = staging.stamped(df, contract, "b1", "drop", "2026-01-01T00:00:00+00:00")
    assert rows.columns == ["id", "agency", "cost", *staging.STAGING_COLUMNS]
    assert rows.filter("agency is null").count() == 1 and rows.filter("cost is null").count() == 2
    objects = staging.manifest(df, "things", "b1", F.lit("A"), F.lit("drop"), F.lit("f"), F.lit("p"))
    shuffled = staging.manifest(df.orderBy(F.col("id").desc()), "things", "b1", F.lit("A"), F.lit("drop"), F.lit("f"), F.lit("p"))
    assert objects.first()["checksum"] == shuffled.first()["checksum"] and objects.first()["row_count"] == 2
    doubled = staging.manifest(df.union(df), "things", "b1", F.lit("A"), F.lit("drop"), F.lit("f"), F.lit("p"))
    assert doubled.first()["checksum"] not in (0, objects.first()["checksum"])
    logs.append_run(logs.run_entry(spark, "e", "things", "r", "b1", "running"), root + "/log")
    logs.append_run(logs.run_entry(spark, "e", "things", "r", "b1", "success", rows_received=2), root + "/log")
    last = logs.latest_runs(logs.run_log(spark, root + "/log")).collect()
    assert [(r["status"], r["rows_received"]) for r in last] == [("success", 2)]
    logs.publish(logs.landing_events(objects, "r", "t"), root + "/events")
    assert json.loads(spark.read.json(root + "/events").first()["value"])["row_count"] == 2
    assert catalog.field_entries(spark, contract, "bronze").filter("type = 'number'").count() == 1
    assert catalog.schema_entries(df, "things").count() == 2
    staging.write_partitioned(df, root + "/gold", "agency", ["id"])
    assert spark.read.parquet(root + "/gold").count() == 2 and staging.clustered(df, ["id"]).count() == 2


def test_profile_and_drift(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, "x")], "n int, s string")
    p = {r["column"]: r for r in profile.column_profile(a, exact=True).collect()}
    assert p["s"]["null_count"] == 1 and p["n"]["distinct_count"] == 2 and p["n"]["mean_value"] == 5 / 3
    rough = {r["column"]: r["distinct_count"] for r in profile.column_profile(a).collect()}
    assert rough == {"n": 2, "s": 1}
    assert profile.column_profile(a.limit(0)).first()["null_pct"] is None
    assert {r["s"] for r in profile.new_values(a, spark.createDataFrame([("y",), ("x",)], "s string"), "s").collect()} == {"y"}


def test_rules_on_empty_and_suites(spark):
    contract = contract_from_mapping(SCHEMA, ALIASING, QUALITY)
    empty = spark.createDataFrame([], "id string, agency string, cost string")
    summary = rules.report(*rules.judged(empty, contract), "things").first()
    assert not summary["hard_rule_pass"] and summary["dqi_rows"] == 0.0 and summary["row_count"] == 0
    rules.register_suite("things", [RuleSpec("cheap", "between", "cost", "soft", {"high": 10})])
    df = spark.createDataFrame([("1", "A", "11"), ("2", "C", "-1"), ("2", "A", "x"), (None, "A", "1"), (None, "B", None)], "id string, agency string, cost string")
    got = {(r["rule"], r["column"]): r for r in rules.rule_results(*rules.judged(df, contract), "id").collect()}
    assert {k: r["failed_count"] for k, r in got.items() if r["failed_count"]} == {
        ("not_null", "id"): 2, ("unique", "id"): 2, ("in_set", "agency"): 1, ("minimum", "cost"): 1, ("between", "cost"): 1, ("type", "cost"): 1}
    rules.register_suite("things", [])
    with pytest.raises(KeyError):
        rules.compile_rules([RuleSpec("x", "no such kind", "id")])


def test_evolution_and_snapshots(spark, root):
    spark.createDataFrame([(1,)], "a int").write.parquet(root + "/t/b=1")
    spark.createDataFrame([(2, "x")], "a int, c string").write.parquet(root + "/t/b=2")
    assert {r["c"] for r in tables.read_evolved(spark, root + "/t").collect()} == {None, "x"}
    at = tables.as_of(tables.read_evolved(spark, root + "/t"), "b", 1)
    assert [r["a"] for r in at.collect()] == [1] and tables.as_of(tables.read_evolved(spark, root + "/t"), "b", 0).count() == 0
