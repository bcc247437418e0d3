"""Manifests, events, catalog records, replaced tables and streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.catalogue import PROJECT_MONITORING
from assaylake.functions.text import safe_id, slug
from assaylake.operators import pii
from assaylake.queries import inputs
from assaylake.queries.channels import CHANGE_COLUMNS, _STATE_SQL, _state_columns, change_log
from assaylake.queries.privacy import CONTACT_POLICY, _CONTACTS, contacts, keys
from assaylake.plans import medallion
from assaylake.queries.registry import day, dbl, query, sql_digest, sql_text, stamp, table
from assaylake.session import scratch_dir
from assaylake.sinks import catalog, logs, staging, versions
from assaylake.streaming import changes


def channel_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as three channels with one object per status."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, day("o_orderdate")).alias("ordered"))
    channel = F.concat(F.lit("channel-"), F.col("o_orderkey") % 3)
    return staging.manifest(o, "orders", "batch-1", F.lit("PCHRD"), channel, F.col("o_orderstatus"), F.lit("landing"))


_ORDER_TEXT = sql_text("o_orderkey::varchar", "o_custkey::varchar", "o_orderstatus", "o_orderpriority", "ordered")
_MANIFEST = f"""
o as (select *, 'channel-' || (o_orderkey % 3) as source_id, case when o_orderkey % 7 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as ordered from orders),
manifest as (select source_id, o_orderstatus as source_object, count(*) as row_count, {sql_digest(_ORDER_TEXT)} as sha256,
             cast(sum(strlen({_ORDER_TEXT})) as bigint) as content_bytes from o group by 1, 2)"""


@query("object_manifest", "with " + _MANIFEST + "select 'orders' as dataset, 'batch-1' as batch_id, source_id, source_object, row_count, sha256, content_bytes from manifest")
def object_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bytes and digest of every object."""
    return channel_manifest(spark, sf_dir).select("dataset", "batch_id", "source_id", "source_object", "row_count", "sha256", "content_bytes")


@query("batch_manifest", "with " + _MANIFEST + """
select 'orders' as dataset, 'batch-1' as batch_id, source_id, cast(sum(row_count) as bigint) as row_count, count(*) as object_count, cast(sum(content_bytes) as bigint) as content_bytes,
       sha256(string_agg(sha256, ',' order by source_object)) as sha256, string_agg(source_object || ' ' || row_count || ' ' || sha256, ',' order by source_object) as objects
from manifest group by 3""")
def batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of every batch, with a digest over theirs."""
    objects = F.array_join(F.transform("objects", lambda o: F.concat_ws(" ", o["source_object"], o["row_count"].cast("string"), o["sha256"])), ",")
    return staging.batch_manifest(channel_manifest(spark, sf_dir)).drop("checksum").withColumn("objects", objects)


@query("retention_tiers", """
with e as (select strftime(ts, '%Y-%m-%d') as day, cast(ts as date) as d, event_type = 'error' as bad from events),
kept as (select case when bad then 'quarantine' else 'archive' end as tier, day, count(*) as n from e
         where d > date '2024-03-20' - case when bad then 14 else 60 end group by 1, 2),
gone as (select case when bad then 'quarantine' else 'archive' end as tier, count(distinct day) as n from e
         where d <= date '2024-03-20' - case when bad then 14 else 60 end group by 1)
select 'kept' as what, tier, day, n from kept union all select 'gone', tier, null, n from gone union all select 'gone again', 'any', null, cast(0 as bigint)""")
def retention_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions by day under two retention periods; a second run removes nothing."""
    root = scratch_dir(spark, "retention")
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "quarantine").otherwise("archive").alias("tier"), day("ts").alias("day"))
    paths = {os.path.join(root, tier): days for tier, days in (("quarantine", 14), ("archive", 60))}
    for path in paths:
        e.where(F.col("tier") == os.path.basename(path)).drop("tier").write.partitionBy("day").parquet(path)
    tier = F.element_at(F.split("path", "/"), -1).alias("tier")
    gone = staging.retained(spark, paths, "2024-03-20", os.path.join(root, "log"))
    again = staging.retained(spark, paths, "2024-03-20", os.path.join(root, "log"))
    out = gone.groupBy(F.lit("gone").alias("what"), tier).agg(F.lit(None).cast("string").alias("day"), F.count("*").alias("n"))
    out = out.unionByName(again.agg(F.count("*").alias("n")).select(F.lit("gone again").alias("what"), F.lit("any").alias("tier"), F.lit(None).cast("string").alias("day"), "n"))
    for path in paths:
        left = spark.read.schema("event_id bigint, day string").parquet(path)
        out = out.unionByName(left.groupBy("day").agg(F.count("*").alias("n")).select(F.lit("kept").alias("what"), F.lit(os.path.basename(path)).alias("tier"), "day", "n"))
    return out


@query("bucketed_silver", "with " + inputs.SILVER + """
select r.project_id, r.project_title, cast(count(*) over (partition by r.project_id) as bigint) as submissions from ranked r qualify row_number() over (partition by r.project_id order by r.rn) = 1""")
def bucketed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row and number of submissions per project from a table bucketed by its key: nothing of it is shuffled again."""
    path = scratch_dir(spark, "silver")
    name = os.path.basename(path).replace("-", "_")
    staging.write_bucketed(inputs.bronze(spark, sf_dir), name, path, ["project_id"], 8)
    rows = spark.table(name)
    latest = medallion.latest_by(rows, ["project_id"], ["last_updated_at"], ["project_title"]).select("project_id", "project_title")
    return latest.join(rows.groupBy("project_id").agg(F.count("*").alias("submissions")), "project_id")


@query("ingestion_lineage", "with " + _MANIFEST + """
select 'orders' as dataset, source_id, cast(sum(row_count) as bigint) as row_count, 'success' as status, 45.0::double as seconds, '2026-01-01' as run_date from manifest group by 2""")
def ingestion_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging.lineage_rows(channel_manifest(spark, sf_dir), "success", 45.0, "2026-01-01")
    return rows.select("dataset", "source_id", "row_count", "status", dbl("ingestion_duration_seconds").alias("seconds"), F.col("run_date").cast("string").alias("run_date"))


@query("landing_events", """
select 'dataset_' || user_id as key, 'dataset_' || user_id as dataset, 'run-1' as run_id, event_type as batch_id, count(*) as row_count from events group by 1, 2, 4""")
def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per landed batch, its JSON read back."""
    m = table(spark, sf_dir, "events").select(F.concat(F.lit("dataset_"), F.col("user_id")).alias("dataset"), F.col("event_type").alias("batch_id"), F.lit(1).alias("row_count"))
    body = F.from_json("value", "dataset string, run_id string, batch_id string, row_count bigint")
    return logs.landing_events(m, "run-1", "2026-01-01T00:00:00Z").select("key", body.alias("b")).select("key", "b.*")


@query("event_log_lines", """
select '{"event":"task_failed","event_id":' || event_id || ',"timestamp":"2026-01-01","user_id":' || user_id || '}' as value from events where event_type = 'error'""")
def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select("event_id", "user_id", F.lit("2026-01-01").alias("at"))
    return logs.event_lines(e, "task_failed", "at")


@query("json_columns", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(coalesce(case when event_id % 10 <> 0 then cast(json_extract(props, '$.k') as bigint) end, -1) as bigint) as k_or_default from events""")
def json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON columns parsed, with a default where the text is missing."""
    from assaylake.functions.text import json_or_default

    text = F.when(F.col("event_id") % 10 != 0, F.col("props"))
    default = F.struct(F.lit(-1).cast("bigint").alias("k"))
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), json_or_default(text, "k bigint", default)["k"].alias("k_or_default"))


@query("safe_names", """
select page_id, regexp_replace(url, '[^A-Za-z0-9._=-]', '_', 'g') as safe, replace(replace(lower(url || ' & More'), ' ', '_'), '&', 'and') as tag from pages""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids made safe for paths, names made into tags."""
    return table(spark, sf_dir, "pages").select("page_id", safe_id(F.col("url")).alias("safe"), slug(F.concat("url", F.lit(" & More"))).alias("tag"))


@query("catalog_column_tags", "with " + _CONTACTS + """
select 'mail' as "column", 'pii_masked' as tag, count(*) as rows from contacts union all select 'person', 'pii_pseudonymized', count(*) from contacts
union all select 'phone', 'pii_masked', count(*) from contacts union all select 'remarks', 'pii_text_redacted', count(*) from contacts""")
def catalog_column_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of protected columns from the findings."""
    rows = contacts(spark, sf_dir)
    guard = pii.protect(rows, CONTACT_POLICY, "record", keys(spark), check_ids=False)
    return catalog.column_tags(guard.findings).withColumn("rows", rows.agg(F.count("*").alias("n")).scalar())


@query("catalog_dataset_entry", "with " + inputs.SILVER + """
select 'silver.project_monitoring' as name, 'silver' as pipeline_stage, 'm_and_e_unit' as owner, 'project_and_knowledge' as tag, count(*) as row_count, 100.0::double as data_quality_index from silver""")
def catalog_dataset_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog row of a layer from its report."""
    from assaylake.operators import rules
    from assaylake.contract import RuleSpec

    s = inputs.silver(spark, sf_dir)
    report = rules.report(s, rules.compile_rules([RuleSpec("k", "not_null", "project_id"), RuleSpec("u", "unique", "project_id")]), "project_monitoring")
    entry = catalog.dataset_entry(report, "project_monitoring", "silver", "M & E unit", "Project & Knowledge", "contract", "2026-01-01")
    return entry.select("name", "pipeline_stage", "owner", F.col("tags")[0].alias("tag"), "row_count", "data_quality_index")


@query("staging_append", "with " + inputs.BRONZE + """
select project_id, strftime(start_date, '%Y-%m-%d') as start_date, cast(budget_allocated_php as varchar) as budget_allocated_php, 'pass' as status, 'orders' as source_id,
       case when project_title like '%7' then '2026-01-01' else '007' end as batch_id from bronze""")
def staging_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two validated batches appended, one of them twice: a retry adds nothing, and ids that look like numbers or dates stay text."""
    staged = inputs.staged_projects(spark, sf_dir).filter(F.col("_validation_status") == "pass").drop("_validation_status", "_ingested_at")
    path = os.path.join(scratch_dir(spark, "staging"), "raw")
    second = F.col("project_title").endswith("7")
    for batch, rows in (("007", staged.filter(~second)), ("2026-01-01", staged.filter(second)), ("2026-01-01", staged.filter(second))):
        staging.append_staging(staging.stamped(rows, PROJECT_MONITORING, batch, "orders", "2026-01-01T00:00:00+00:00"), path)
    return staging.read_staging(spark, path).select("project_id", "start_date", "budget_allocated_php", F.col("_validation_status").alias("status"),
                                           F.col("_source_id").alias("source_id"), F.col("_batch_id").alias("batch_id"))


@query("layer_replace", """
select c_custkey as site, c_mktsegment as kind, 2 as version, 'b1,b2' as batches from customer where c_custkey % 2 = 0""")
def layer_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a newer batch; a load with other columns is refused and changes nothing."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site"), F.col("c_mktsegment").alias("kind"))
    store = versions.VersionedTables(spark, scratch_dir(spark, "versions"))
    store.replace("sites", c, "b1")
    store.replace("sites", c.filter(F.col("site") % 2 == 0), "b2")
    try:
        store.replace("sites", c.withColumn("extra", F.lit(1)), "b3")
    except versions.LoadRefused:
        pass
    current = store.published().filter(F.col("table") == "sites").agg(F.max("version").cast("int").alias("v")).scalar()
    batches = store.batches("sites").select(F.array_join("batches", ",").alias("b")).scalar()
    return store.read("sites").withColumns({"version": current, "batches": batches})


@query("cdc_stream_state", _STATE_SQL)
def cdc_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change events as file streams under two checkpoints, a snapshot between them, folded into one state table."""
    root = scratch_dir(spark, "changes")
    log = change_log(spark, sf_dir).filter(F.col("value").isNotNull())
    state = changes.StateTable(spark, os.path.join(root, "state"), ["user_id"])
    early = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part, rows in (("first", log.filter(early)), ("second", log.filter(~early))):
        rows.repartition(4).write.text(os.path.join(root, part))
        events = changes.file_changes(spark, os.path.join(root, part), CHANGE_COLUMNS, files_per_batch=2)
        changes.run_state(events, CHANGE_COLUMNS, state, os.path.join(root, f"checkpoint-{part}")).awaitTermination()
        if part == "first":
            state.compact()
    return _state_columns(state.current())


@query("stream_window_counts", """
select strftime(time_bucket(interval '5 minutes', ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as n from events
where event_type in ('signup', 'purchase') group by 1, 2""")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted operations per five minutes from a file stream whose micro batches come out of order; every window comes out."""
    root = scratch_dir(spark, "windows")
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.repartition(4).write.parquet(os.path.join(root, "in"))
    stream = spark.readStream.option("maxFilesPerTrigger", 2).schema(e.schema).parquet(os.path.join(root, "in"))
    out = os.path.join(root, "out")
    changes.run_window_counts(stream, "ts", "event_type", out, os.path.join(root, "checkpoint"), ["signup", "purchase"]).awaitTermination()
    return changes.window_totals(spark, out).select(stamp("window_start").alias("window_start"), F.col("kind").alias("event_type"), "n")


@query("landing_stream", "select cast(event_id as varchar) as key, event_type, cast(user_id as bigint) as user_id from events")
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows streamed out as key and JSON value, read back."""
    root = scratch_dir(spark, "landing")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    e.write.parquet(os.path.join(root, "in"))
    stream = spark.readStream.schema(e.schema).parquet(os.path.join(root, "in"))
    out = changes.landing_stream(stream, "event_id")
    changes.run_append(out, os.path.join(root, "out"), os.path.join(root, "checkpoint")).awaitTermination()
    body = F.from_json("value", "event_type string, user_id bigint")
    return spark.read.parquet(os.path.join(root, "out")).select("key", body.alias("b")).select("key", "b.*")
