"""Reading channels and bringing them to canonical form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.contract import Contract, Field
from assaylake.functions.text import currency_to_double, epoch_days_to_date
from assaylake.operators import canonical, cdc, joins
from assaylake.queries.inputs import SUBMISSION_ALIASES, SUBMISSIONS, raw_submissions
from assaylake.queries.registry import day, dbl, query, stamp, table
from assaylake.session import scratch_dir
from assaylake.sources import files, records

_CANONICAL_SQL = "with " + SUBMISSIONS + """
select project_id, project_title, program_area, strftime(start_date, '%Y-%m-%d') as start_date,
       strftime(end_date, '%Y-%m-%d') as end_date, cast(budget_allocated_php as double) as budget_allocated_php,
       cast(budget_utilized_php as double) as budget_utilized_php, status
from submissions"""


@query("canonicalize_alias", _CANONICAL_SQL)
def canonicalize_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw column names, US dates and currency text to canonical columns."""
    return canonical.aliased(raw_submissions(spark, sf_dir), SUBMISSION_ALIASES)


@query("csv_folder_scan", _CANONICAL_SQL)
def csv_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows after a trip through a folder of CSV files."""
    raw = raw_submissions(spark, sf_dir)
    folder = scratch_dir(spark, "csv")
    raw.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(folder)
    back = files.read_csv_folder(spark, folder, raw.columns, "*.csv,*.txt")
    return canonical.aliased(back, SUBMISSION_ALIASES)


ORDER_CONTRACT = Contract("orders", fields=(
    Field("o_orderkey", "integer", True), Field("o_custkey", "integer", True), Field("o_orderstatus"),
    Field("o_orderpriority"), Field("agency"), Field("region")), unique_fields=("o_orderkey",))


@query("identity_pass_through", "select o_custkey, o_orderkey, o_orderstatus from orders")
def identity_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Contract("o", tuple(Field(n) for n in ("o_orderkey", "o_custkey", "o_orderstatus")))
    return canonical.only_canonical(canonical.identity(table(spark, sf_dir, "orders"), contract), contract)


@query("source_constants", """
select o_orderkey, 'PCHRD' as agency_source_first, coalesce(case when o_orderkey % 3 <> 0 then o_orderstatus end, 'PCHRD') as agency_row_first,
       case when o_orderkey % 5 <> 0 then o_orderpriority end as region, 'unknown' as region_absent
from orders""")
def source_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency and region by both precedences, and where the source and the row have neither."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("agency"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("region"))
    fixed = {"agency": "PCHRD"}
    both = canonical.with_constants(o.withColumn("own", F.col("agency")), ORDER_CONTRACT, fixed)
    both = both.withColumnRenamed("agency", "agency_source_first").withColumnRenamed("own", "agency")
    both = canonical.with_constants(both, ORDER_CONTRACT, fixed, "row_first").withColumnRenamed("agency", "agency_row_first")
    kept = both.withColumnRenamed("region", "own_region")
    only_region = Contract("r", (Field("region"),))
    return canonical.with_constants(kept, only_region, {}).select(
        "o_orderkey", "agency_source_first", "agency_row_first", F.col("own_region").alias("region"),
        F.col("region").alias("region_absent"))


@query("multi_table_left_join", """
select c_custkey, c_name, n_name, r_name, cast(c_acctbal as double) as c_acctbal
from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def multi_table_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, nation and region, each joined on the shared key of the step."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    wide = joins.join_tables([table(spark, sf_dir, "customer"), nation], "c_nationkey")
    return joins.join_tables([wide, region], "n_regionkey").select("c_custkey", "c_name", "n_name", "r_name", "c_acctbal")


@query("shared_key_left_joins", """
with spend as (select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spent from orders group by 1),
     firsts as (select o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') as first_order from orders where o_orderstatus = 'P' group by 1)
select c_custkey, c_name, spent, first_order
from customer left join spend s on s.o_custkey = c_custkey left join firsts f on f.o_custkey = c_custkey""")
def shared_key_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables on one key; the first drives."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    spend = o.groupBy("c_custkey").agg(dbl(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("spent"))
    firsts = o.filter(F.col("o_orderstatus") == "P").groupBy("c_custkey").agg(day(F.min("o_orderdate")).alias("first_order"))
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.join_tables([people, spend, firsts], "c_custkey")


@query("channel_union", """
select o_orderkey, cast(o_totalprice as double) as o_totalprice, o_orderstatus, null::varchar as o_orderpriority from orders where o_orderkey % 3 = 0
union all select o_orderkey, null, o_orderstatus, o_orderpriority from orders where o_orderkey % 3 = 1
union all select o_orderkey, cast(o_totalprice as double), null, o_orderpriority from orders where o_orderkey % 3 = 2""")
def channel_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three channels with different columns, aligned by name."""
    o = table(spark, sf_dir, "orders")
    part = F.col("o_orderkey") % 3
    return canonical.union_channels([
        o.filter(part == 0).select("o_orderkey", "o_totalprice", "o_orderstatus"),
        o.filter(part == 1).select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        o.filter(part == 2).select("o_orderpriority", "o_orderkey", "o_totalprice"),
    ])


@query("json_records_extract", "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, cast(o_custkey as varchar) as o_custkey from orders")
def json_records_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 200 records as API payloads, taken apart again. Every other page is a plain list."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    page = F.floor(F.col("o_orderkey") / 200)
    pages = o.groupBy(page.alias("page")).agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_custkey")).alias("records"))
    value = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.struct("records").alias("data")))).otherwise(F.to_json("records"))
    return records.explode_records(pages.select(value.alias("value")), ["o_orderkey", "o_orderstatus", "o_custkey"])


@query("protocol_log_extract", "select cast(event_id as varchar) as event_id, event_type from events where event_type <> 'error'")
def protocol_log_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RECORD messages among other messages and plain log lines."""
    e = table(spark, sf_dir, "events")
    data = F.struct(F.struct("event_id", "event_type").alias("data"))
    record = F.to_json(F.struct(F.lit("RECORD").alias("type"), data.alias("record")))
    state = F.to_json(F.struct(F.lit("STATE").alias("type"), data.alias("record")))
    noise = F.concat(F.lit("INFO read event "), F.col("event_id"))
    line = F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, noise).otherwise(state)).otherwise(record)
    return records.protocol_records(e.select(line.alias("value")), ["event_id", "event_type"])


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change events of one row per user: errors delete, sign-ups create.

    Deletes carry a before image, every seventh event uses the alternative names, purchases have no
    operation, and every thirteenth value is a tombstone.
    """
    e = table(spark, sf_dir, "events")
    image = F.struct(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("kind"),
                     F.col("event_id").cast("string").alias("event_id"))
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").when(
        F.col("event_type") == "purchase", None).otherwise("u")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    after = F.when(op.isNull() | (op != "d"), image)
    usual = F.to_json(F.struct(op.alias("op"), F.when(op == "d", image).alias("before"), after.alias("after"),
                               F.struct(F.lit("users").alias("table")).alias("source"), at.alias("ts_ms")))
    other = F.to_json(F.struct(F.coalesce(op, F.lit("update")).alias("operation"), image.alias("data"), F.lit("users").alias("table"),
                               at.alias("timestamp")))
    value = F.when(F.col("event_id") % 13 == 0, None).when(F.col("event_id") % 7 == 0, other).otherwise(usual)
    return e.select(value.alias("value"))


CHANGE_COLUMNS = ["user_id", "kind", "event_id"]

_STATE_SQL = """
with ranked as (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events where event_id % 13 <> 0)
select cast(user_id as varchar) as user_id, event_type as kind, cast(event_id as varchar) as event_id,
       case when event_type = 'signup' then 'c' when event_type = 'purchase' and event_id % 7 = 0 then 'update' else 'u' end as op, 'users' as source_table
from ranked where rn = 1 and event_type <> 'error'"""


def _state_columns(df: DataFrame) -> DataFrame:
    return df.select("user_id", "kind", "event_id", F.col("_cdc_operation").alias("op"), F.col("_source_table").alias("source_table"))


@query("cdc_current_state", _STATE_SQL)
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events to the rows that exist now."""
    rows = cdc.change_rows(records.parse_changes(change_log(spark, sf_dir), CHANGE_COLUMNS), CHANGE_COLUMNS)
    return _state_columns(cdc.current_state(rows, ["user_id"]))


@query("cdc_operation_counts", """
select case when event_type = 'view' then 'truncate' when event_type = 'error' then 'd' when event_type = 'signup' then 'c' else 'u' end as op,
       case when event_type = 'view' then 0 else 1 end as supported, count(*) as n
from events group by 1, 2""")
def cdc_operation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations with unknown ones kept aside instead of failing the batch."""
    e = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "view", "truncate").when(F.col("event_type") == "error", "d").when(
            F.col("event_type") == "signup", "c").alias("op"),
        F.struct(F.col("user_id").cast("string").alias("user_id")).alias("after"))
    rows = cdc.change_rows(e, ["user_id"], on_unknown="keep")
    known = F.when(F.col("_cdc_operation").isin(*cdc.OPERATIONS), 1).otherwise(0)
    return rows.groupBy(F.col("_cdc_operation").alias("op"), known.alias("supported")).agg(F.count("*").alias("n"))


@query("epoch_day_decode", """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as from_days, strftime(o_orderdate, '%Y-%m-%d') as from_text,
       case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') end as from_mixed
from orders""")
def epoch_day_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day numbers, ISO text and unreadable text as dates."""
    o = table(spark, sf_dir, "orders")
    days = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("string")
    mixed = F.when(F.col("o_orderkey") % 2 == 0, days).otherwise(F.lit("soon"))
    return o.select("o_orderkey", day(epoch_days_to_date(days)).alias("from_days"),
                    day(epoch_days_to_date(day("o_orderdate"))).alias("from_text"), day(epoch_days_to_date(mixed)).alias("from_mixed"))


@query("currency_edge_cases", """
select o_orderkey, case o_orderkey % 5 when 0 then cast(o_totalprice as double) when 1 then -cast(o_totalprice as double)
       when 2 then null when 3 then null else cast(o_totalprice as double) end as amount,
       case o_orderkey % 5 when 0 then cast(o_totalprice as double) when 1 then -cast(o_totalprice as double)
       when 2 then null when 3 then null else -cast(o_totalprice as double) end as amount_signed
from orders""")
def currency_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols, signs, blanks, junk and accounting parentheses."""
    number = F.format_number("o_totalprice", 2)
    case = F.col("o_orderkey") % 5
    text = F.when(case == 0, F.concat(F.lit("Php "), number)).when(case == 1, F.concat(F.lit("-"), number)).when(
        case == 2, F.lit("  ")).when(case == 3, F.lit("-")).otherwise(F.concat(F.lit("("), number, F.lit(")")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")).select(
        "o_orderkey", currency_to_double(F.col("t")).alias("amount"), currency_to_double(F.col("t"), True).alias("amount_signed"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a listing of staged files: user is the layer, k of the props the batch."""
    e = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type").isin("click", "view"), "part.parquet").otherwise("vault.parquet")
    kept = F.when(F.col("event_type") == "error", F.concat(F.lit("staging/quarantine/"), F.col("event_id"))).otherwise(
        F.concat(F.lit("staging/"), F.col("event_id")))
    return e.select(
        F.concat(F.lit("layer_"), F.col("user_id")).alias("layer"),
        F.concat(F.lit("batch_"), F.get_json_object("props", "$.k")).alias("batch"),
        name.alias("file_name"), F.col("ts").alias("modified"), kept.alias("path"))


_LISTING = """
listing as (
  select 'layer_' || user_id as layer, 'batch_' || json_extract_string(props, '$.k') as batch,
         case when event_type in ('click', 'view') then 'part.parquet' else 'vault.parquet' end as file_name, ts as modified,
         case when event_type = 'error' then 'staging/quarantine/' || event_id else 'staging/' || event_id end as path
  from events)"""


@query("latest_complete_batch", "with " + _LISTING + """,
complete as (
  select layer, batch, max(case when file_name = 'part.parquet' then modified end) as seen from listing
  group by 1, 2 having count(distinct file_name) = 2)
select layer, arg_max(batch, {'s': seen, 'b': batch}) as batch, strftime(max(seen), '%Y-%m-%d %H:%M:%S') as modified from complete group by 1""")
def latest_complete_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per layer the newest batch with both of its files."""
    return files.latest_complete_batch(file_listing(spark, sf_dir), ["part.parquet", "vault.parquet"]).select(
        "layer", "batch", stamp("modified").alias("modified"))


@query("latest_file_per_source", "with " + _LISTING + """
select layer, arg_max(path, {'m': modified, 'p': path}) as path, strftime(max(modified), '%Y-%m-%d %H:%M:%S') as modified
from listing where path not like '%quarantine/%' group by 1""")
def latest_file_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.latest_per_source(file_listing(spark, sf_dir), "layer").select("layer", "path", stamp("modified").alias("modified"))


@query("newest_file", "with " + _LISTING + """
select arg_max(path, {'m': modified, 'p': path}) as path, strftime(max(modified), '%Y-%m-%d %H:%M:%S') as modified,
       count(*) - 1 as other_candidates from listing""")
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.newest_file(file_listing(spark, sf_dir)).select("path", stamp("modified").alias("modified"), "other_candidates")


@query("trimmed_report_lines", "select item_id, text from benchmark where not regexp_matches(text, '^(Th|Re)')")
def trimmed_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and footer lines dropped by what they look like."""
    return files.without_trimmed_rows(table(spark, sf_dir, "benchmark"), "text", "^(Th|Re)")


@query("cdc_broken_events", """
select event_id, case event_id % 9 when 0 then 'broken' when 1 then 'broken' when 2 then 'broken' else 'fine' end as kind,
       case when event_id % 9 > 2 then cast(user_id as varchar) end as user_id,
       case event_id % 9 when 0 then '{"op":"c","after":{"user_id":' || event_id when 1 then '[' || event_id || ']' when 2 then '{"op":"c","ts_ms":"noon' || event_id || '"}' end as text
from events""")
def cdc_broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are cut off, no object or of other types are kept with their text beside those that can be read."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    kind = F.col("event_id") % 9
    text = F.when(kind == 0, F.concat(F.lit('{"op":"c","after":{"user_id":'), "event_id")).when(kind == 1, F.concat(F.lit("["), "event_id", F.lit("]"))).when(
        kind == 2, F.concat(F.lit('{"op":"c","ts_ms":"noon'), "event_id", F.lit('"}'))).otherwise(
        F.to_json(F.struct(F.lit("c").alias("op"), F.struct(F.col("user_id").cast("string").alias("user_id"), F.col("event_id").cast("string").alias("event_id")).alias("after"))))
    parsed = records.parse_changes(e.select(text.alias("value")), ["user_id", "event_id"], on_broken="keep")
    own = F.coalesce(F.col("after.event_id"), F.regexp_extract(records.BROKEN, "([0-9]+)", 1)).cast("long")
    return parsed.select(own.alias("event_id"), F.when(F.col(records.BROKEN).isNull(), "fine").otherwise("broken").alias("kind"),
                         F.col("after.user_id").alias("user_id"), F.col(records.BROKEN).alias("text"))


@query("json_broken_pages", """
with p as (select o_custkey as page, count(*) as n from orders group by 1)
select case when page % 4 in (0, 1) then 'read' else 'kept' end as what, cast(sum(case when page % 4 in (0, 1) then n else 1 end) as bigint) as row_count from p group by 1""")
def json_broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are cut off or hold no list are kept as rows of their own; the records of the others are read."""
    o = table(spark, sf_dir, "orders")
    pages = o.groupBy(F.col("o_custkey").alias("page")).agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("list"))
    kind = F.col("page") % 4
    text = F.when(kind == 0, F.concat(F.lit('{"data":{"records":'), "list", F.lit("}}"))).when(kind == 1, F.col("list")).when(
        kind == 2, F.concat(F.lit('{"data":{"records":'), F.expr("left(list, length(list) - 3)"))).otherwise(F.concat(F.lit('{"items":'), "list", F.lit("}")))
    rows = records.explode_records(pages.select(text.alias("value")), ["o_orderkey", "o_orderstatus"], on_broken="keep")
    return rows.groupBy(F.when(F.col(records.BROKEN).isNull(), "read").otherwise("kept").alias("what")).agg(F.count("*").alias("row_count"))
