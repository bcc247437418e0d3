"""Finding, treating, vaulting and auditing personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import spans as sp
from assaylake.functions.crypto import KeyRing
from assaylake.functions.text import mask_digits_keep3, mask_text
from assaylake.operators import pii
from assaylake.operators.joins import round_trip_mismatches
from assaylake.queries import inputs
from assaylake.queries.registry import day, dbl, query, table
from assaylake.session import scratch_dir, spread

# Keys of the registered queries only; real runs bring their own.
_HMAC = b"query hmac key"
_ENC = {1: b"0123456789abcdef", 2: b"fedcba9876543210"}


def keys(spark: SparkSession, newest: int = 1) -> KeyRing:
    return KeyRing(spark, _HMAC, {v: k for v, k in _ENC.items() if v <= newest})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def hits_sql(recognizers, source: str = "documents", key: str = "doc_id", text: str = "text", threshold: float = 0.4) -> str:
    """Spans of every recognizer, then overlapping ones joined, as common table expressions."""
    parts = []
    for r in recognizers:
        boosted = min(1.0, max(r.score + sp.BOOST, sp.BOOST_FLOOR))
        context = _sql_text("|".join(r.context)) if r.context else "null"
        parts.append(
            f"select {key} as id, {text} as t, '{r.entity}' as entity, cast({r.score} as double) as base, cast({boosted} as double) as boosted, "
            f"{context} as ctx, regexp_extract_all({text}, {_sql_text(r.pattern)}) as h, string_split_regex({text}, {_sql_text(r.pattern)}) as p "
            f"from {source} where regexp_matches({text}, {_sql_text(r.pattern)})")
    return f"""
cuts as ({' union all '.join(parts)}),
spots as (select *, unnest(range(1, len(h) + 1)) as i from cuts),
placed as (
  select id, t, entity, base, boosted, ctx, length(h[i]) as n,
         cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) as bigint) as s
  from spots),
scored as (
  select id, entity, s, s + n as e,
         case when ctx is not null and regexp_matches(lower(regexp_extract(substr(t, 1, s),
              '(?:\\w+\\W+){{0,{sp.CONTEXT_WORDS}}}\\w*$')), ctx) then boosted else base end as score
  from placed),
kept as (select * from scored where score >= {threshold}),
runs as (
  select *, max(e) over (partition by id order by s, -score, e, entity rows between unbounded preceding and 1 preceding) as reach from kept),
islands as (
  select *, sum(case when reach is null or s >= reach then 1 else 0 end) over (partition by id order by s, -score, e, entity rows unbounded preceding) as island from runs),
spans as (
  select id, min(s) as s, max(e) as e, max(score) as score, first(entity order by score desc, s, e, entity) as entity
  from islands group by id, island)"""


@query("pii_mask_email", """
select c_custkey, case when c_custkey % 3 = 0 then substr(c_name, 1, 1) || '***' when c_custkey % 3 = 1 then 'u***@' || c_mktsegment || '.example.org'
       else '***@' || c_mktsegment || '.org' end as masked from customer""")
def pii_mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail addresses, other text, and an address with nothing before its sign."""
    kind = F.col("c_custkey") % 3
    text = F.when(kind == 0, F.col("c_name")).when(
        kind == 1, F.concat(F.lit("u"), F.col("c_custkey"), F.lit("@"), F.col("c_mktsegment"), F.lit(".example.org"))).otherwise(
        F.concat(F.lit("@"), F.col("c_mktsegment"), F.lit(".org")))
    return table(spark, sf_dir, "customer").select("c_custkey", mask_text(text).alias("masked"))


@query("pii_mask_digits", """
with t as (select c_custkey, case when c_custkey % 5 = 0 then 'no. ' || (c_custkey % 900) else '(0' || (c_custkey % 90 + 10) || ') ' || lpad(cast(c_custkey % 10000 as varchar), 4, '0') || ' x ' || (c_custkey % 1000) end as v from customer),
     d as (select *, length(regexp_replace(v, '[^0-9]', '', 'g')) as n from t)
select c_custkey, list_aggregate(list_transform(range(1, length(v) + 1), lambda i: case when regexp_matches(v[i], '[0-9]')
       and (n <= 3 or length(regexp_replace(v[i:], '[^0-9]', '', 'g')) > 3) then '*' else v[i] end), 'string_agg', '') as masked from d""")
def pii_mask_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits masked but for the last three; short numbers masked whole."""
    key = F.col("c_custkey")
    text = F.when(key % 5 == 0, F.concat(F.lit("no. "), key % 900)).otherwise(
        F.concat(F.lit("(0"), key % 90 + 10, F.lit(") "), F.lpad((key % 10000).cast("string"), 4, "0"), F.lit(" x "), key % 1000))
    return table(spark, sf_dir, "customer").select("c_custkey", mask_digits_keep3(text).alias("masked"))


def _pad(byte: int) -> str:
    return bytes(b ^ byte for b in _HMAC.ljust(64, b"\0")).hex()


@query("pii_pseudonym", f"""
select c_custkey, 'vault:v1:' || to_base64(unhex(sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(c_name)))))) as pseudonym from customer""")
def pii_pseudonym(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed pseudonyms; the SQL works the HMAC out by hand."""
    return table(spark, sf_dir, "customer").select("c_custkey", keys(spark).pseudonym(F.col("c_name")).alias("pseudonym"))


@query("pii_spans", "with " + hits_sql(sp.DEFAULT_RECOGNIZERS) + """
select id as doc_id, entity, cast(s as bigint) as start_at, cast(e as bigint) as end_at, round(score, 3) as score from spans""")
def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document holds personal data, overlaps joined, context counted in."""
    d = documents(spark, sf_dir)
    found = d.select("doc_id", F.explode_outer(sp.detected("text")).alias("s"))
    return found.filter(F.col("s").isNotNull()).select("doc_id", "s.entity", F.col("s.start").cast("bigint").alias("start_at"), F.col("s.end").cast("bigint").alias("end_at"),
                        F.round("s.score", 3).alias("score"))


_FAR = (300, 5000)  # letters of a word between a context word and its number


@query("pii_far_context", f"""
with documents_far as (
  select doc_id, 'gsis ' || repeat('x', case when doc_id % 2 = 0 then {_FAR[0]} else {_FAR[1]} end) || ' ' || lpad(cast(doc_id as varchar), 11, '0')
         || case when doc_id % 3 = 0 then ' a b c d e f ' || lpad(cast(doc_id + 1 as varchar), 11, '0') else '' end || ' ' || text as text from documents),
""" + hits_sql([r for r in sp.DEFAULT_RECOGNIZERS if r.entity == "PH_GSIS"], source="documents_far") + """
select id as doc_id, cast(s as bigint) as start_at, round(score, 3) as score from spans""")
def pii_far_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers whose context word lies within five words but hundreds or thousands of letters before; without one there is no finding."""
    key = F.col("doc_id")
    far = F.when(key % 2 == 0, F.lit(_FAR[0])).otherwise(F.lit(_FAR[1]))
    second = F.when(key % 3 == 0, F.concat(F.lit(" a b c d e f "), F.lpad((key + 1).cast("string"), 11, "0"))).otherwise("")
    text = F.concat(F.lit("gsis "), F.repeat(F.lit("x"), far), F.lit(" "), F.lpad(key.cast("string"), 11, "0"), second, F.lit(" "), F.col("text"))
    found = documents(spark, sf_dir).select("doc_id", text.alias("text")).select("doc_id", F.explode(sp.detected("text", ["PH_GSIS"])).alias("s"))
    return found.select("doc_id", F.col("s.start").cast("bigint").alias("start_at"), F.round("s.score", 3).alias("score"))


@query("pii_findings", "with " + hits_sql(sp.DEFAULT_RECOGNIZERS) + """
select 'text' as "column", entity, count(*) as "count", round(min(score), 3) as min_score, round(max(score), 3) as max_score, 'replace_in_text' as treatment
from spans group by 2""")
def pii_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and scores per entity of an undeclared text column."""
    guard = pii.protect(documents(spark, sf_dir), pii.Policy(), "doc_id", keys(spark), check_ids=False)
    return guard.findings.select("column", "entity", "count", "min_score", "max_score", "treatment")


@query("pii_redact_text", "with " + hits_sql(sp.DEFAULT_RECOGNIZERS) + """,
ordered as (select *, coalesce(lag(e) over (partition by id order by s), 0) as before from spans),
pieces as (
  select id, string_agg(substr(text, before + 1, s - before) || '<' || entity || '>', '' order by s) as head, max(e) as tail
  from ordered join documents on doc_id = id group by id)
select doc_id, md5(coalesce(head || substr(text, tail + 1), text)) as digest, length(coalesce(head || substr(text, tail + 1), text)) as n_chars
from documents left join pieces on id = doc_id""")
def pii_redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with every finding replaced, compared by digest."""
    guard = pii.protect(documents(spark, sf_dir), pii.Policy(), "doc_id", keys(spark), check_ids=False)
    return guard.serving.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with contact details and remarks holding some of them."""
    key = F.col("c_custkey")
    phone = F.concat(F.lit("0917 "), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(" "), F.lpad((key % 10000).cast("string"), 4, "0"))
    mail = F.concat(F.lit("person."), key, F.lit("@example.org"))
    tin = F.concat_ws("-", F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("456"), F.lit("789"))
    remark = F.when(key % 4 == 0, F.concat(F.lit("Call "), phone, F.lit(" about it"))).when(
        key % 4 == 1, F.concat(F.lit("Write to "), mail, F.lit(", TIN "), tin)).when(key % 4 == 2, "No contact recorded").otherwise("")
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")).select(
        F.concat(F.lit("f"), key).alias("record"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("person"),
        phone.alias("phone"), mail.alias("mail"), remark.alias("remarks"))


CONTACT_POLICY = pii.policy_from({
    "skip_columns": ["segment"],
    "columns": {"person": {"serving": "pseudonymize"}, "mail": {"serving": "mask"}, "phone": {"serving": "mask_last3"},
                "remarks": {"serving": "replace_in_text"}},
})

_CONTACTS = """
contacts as (
  select c_custkey as k, 'f' || c_custkey as record, c_mktsegment as segment, c_name as person,
         lpad(cast(c_custkey % 1000 as varchar), 3, '0') as a, lpad(cast(c_custkey % 10000 as varchar), 4, '0') as b,
         'person.' || c_custkey || '@example.org' as mail
  from customer)"""


@query("pii_serving", "with " + _CONTACTS + """
select record, segment, 'p***@example.org' as mail, '**** *** *' || substr(b, 2) as phone,
       case k % 4 when 0 then 'Call <PH_PHONE> about it' when 1 then 'Write to <EMAIL_ADDRESS>, TIN <PH_TIN>' when 2 then 'No contact recorded' else '' end as remarks
from contacts""")
def pii_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving copy of a contact table (the pseudonym has a query of its own)."""
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark))
    return guard.serving.select("record", "segment", "mail", "phone", "remarks")


_VAULT = "with " + _CONTACTS + """,
vault as (
  select record as record_id, 'person' as column_name, person as value from contacts
  union all select record, 'mail', mail from contacts
  union all select record, 'phone', '0917 ' || a || ' ' || b from contacts
  union all select record, 'remarks', case k % 4 when 0 then 'Call 0917 ' || a || ' ' || b || ' about it'
    when 1 then 'Write to ' || mail || ', TIN <PH_TIN>' else 'No contact recorded' end from contacts where k % 4 <> 3)
"""


@query("pii_vault_roundtrip", _VAULT + "select record_id, column_name, value from vault")
def pii_vault_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted and decrypted again: the originals, but for government ids."""
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    return pii.revealed(guard.vault, keys(spark))


@query("pii_vault_mismatches", _VAULT + """, originals as (select record as record_id, 'person' as column_name, case when k % 50 = 0 then upper(person) else person end as value from contacts)
select v.record_id, v.column_name, v.value as "left", o.value as "right" from vault v join originals o using (record_id, column_name) where v.value <> o.value and v.record_id not like '%7'
union all select v.record_id, v.column_name, v.value, null from vault v join originals o using (record_id, column_name) where v.record_id like '%7'
union all select record_id || '#', column_name, null, null from originals where record_id like '%7'""")
def pii_vault_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decrypted vault against originals of which some were changed, some are missing, and some are null where the vault has no row."""
    rows = contacts(spark, sf_dir)
    guard = pii.protect(rows, CONTACT_POLICY, "record", keys(spark), check_ids=False)
    number = F.substring("record", 2, 20).cast("bigint")
    originals = rows.select(F.col("record").alias("record_id"), F.lit("person").alias("column_name"),
                            F.when(number % 50 == 0, F.upper("person")).otherwise(F.col("person")).alias("value"))
    some = F.col("record_id").endswith("7")
    extra = originals.filter(some).select(F.concat("record_id", F.lit("#")).alias("record_id"), "column_name", F.lit(None).cast("string").alias("value"))
    originals = originals.filter(~some).unionByName(extra)
    revealed = pii.revealed(guard.vault, keys(spark), columns=["person"])
    return round_trip_mismatches(revealed, originals, ["record_id", "column_name"], "value")


@query("pii_key_rotation", _VAULT + "select record_id, column_name, value, 2 as key_version from vault")
def pii_key_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vault moved to a newer key still opens."""
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    ring = keys(spark, newest=2)
    fresh = pii.rotated(guard.vault, ring)
    return fresh.select("record_id", "column_name", ring.decrypted(F.col("ciphertext")).alias("value"), "key_version")


@query("pii_reveal_by_record", "with " + _CONTACTS + """
select record as record_id, mail, person from contacts join orders on o_custkey = k group by 1, 2, 3""")
def pii_reveal_by_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of the customers that ordered, one map per record."""
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    ids = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), F.col("o_custkey")).alias("id"))
    out = pii.revealed_by_record(guard.vault, keys(spark), ids, ["mail", "person"])
    return out.select("record_id", F.col("contacts")["mail"].alias("mail"), F.col("contacts")["person"].alias("person"))


@query("pii_erasure", _VAULT + """select column_name, count(*) as n from vault
where cast(substr(record_id, 2) as bigint) not in (select o_custkey from orders where o_orderstatus = 'P') group by 1""")
def pii_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vault without the people who asked to be forgotten."""
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    ids = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P").select(F.concat(F.lit("f"), F.col("o_custkey")).alias("id"))
    return pii.erased(guard.vault, ids).groupBy("column_name").agg(F.count("*").alias("n"))


@query("pii_stats", "with " + _CONTACTS + """
select count(*) as rows, cast(4 as bigint) as columns_scanned, 'mail,person,phone,remarks' as columns_protected,
       cast(count(*) * 3 + count(*) filter (where k % 4 <> 3) as bigint) as vault_rows from contacts""")
def pii_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    return guard.stats.withColumn("columns_protected", F.array_join("columns_protected", ","))


@query("pii_contact_findings", "with " + _CONTACTS + """
select 'mail' as "column", 'declared' as entity, count(*) as "count", 'mask' as treatment from contacts
union all select 'mail', 'EMAIL_ADDRESS', count(*), 'mask' from contacts
union all select 'person', 'declared', count(*), 'pseudonymize' from contacts
union all select 'phone', 'declared', count(*), 'mask_last3' from contacts
union all select 'phone', 'PH_PHONE', count(*), 'mask_last3' from contacts
union all select 'remarks', 'declared', count(*) filter (where k % 4 <> 3), 'replace_in_text' from contacts
union all select 'remarks', 'PH_PHONE', count(*) filter (where k % 4 = 0), 'replace_in_text' from contacts
union all select 'remarks', 'EMAIL_ADDRESS', count(*) filter (where k % 4 = 1), 'replace_in_text' from contacts
union all select 'remarks', 'PH_TIN', count(*) filter (where k % 4 = 1), 'replace_in_text' from contacts""")
def pii_contact_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    guard = pii.protect(contacts(spark, sf_dir), CONTACT_POLICY, "record", keys(spark), check_ids=False)
    return guard.findings.select("column", "entity", "count", "treatment")


@query("pii_audit_rescan", "with " + hits_sql([r for r in sp.DEFAULT_RECOGNIZERS if r.entity in pii.AUDIT_ENTITIES]) + """
select 'before' as stage, 'text' as "column", entity, count(*) as "count" from spans group by 3""")
def pii_audit_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second detection: findings in the source, none in the serving copy."""
    d = documents(spark, sf_dir)
    guard = pii.protect(d, pii.Policy(), "doc_id", keys(spark), check_ids=False)
    before = pii.rescanned(d).withColumn("stage", F.lit("before"))
    after = pii.rescanned(guard.serving).withColumn("stage", F.lit("after"))
    return before.unionByName(after).select("stage", "column", "entity", "count")


_KNOWN = ["person.1@", "0917 0", "TIN 0", "Customer#00000000", "#", "r#", "none of them"]


@query("pii_leak_search", "with " + _CONTACTS + """,
full_text as (select k, person, mail, '0917 ' || a || ' ' || b as phone, case k % 4 when 0 then 'Call 0917 ' || a || ' ' || b || ' about it'
    when 1 then 'Write to ' || mail || ', TIN ' || a || '-456-789' when 2 then 'No contact recorded' else '' end as remarks, record, segment from contacts),
long as (select unnest(['record', 'segment', 'person', 'phone', 'mail', 'remarks']) as "column", unnest([record, segment, person, phone, mail, remarks]) as v from full_text),
known as (select distinct value from (select mail as value from full_text where k % 7 = 0 union all select phone from full_text where k % 5 = 0
    union all select unnest(['person.1@', '0917 0', 'TIN 0', 'Customer#00000000', '#', 'r#', 'none of them'])))
select 'source' as side, "column", count(*) filter (where exists (select 1 from known where contains(v, value))) as cells from long group by 2
union all select 'serving', "column", cast(0 as bigint) from (select distinct "column" from long)""")
def pii_leak_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known values, a table that grows with the contacts, searched in every text column before and after protection."""
    rows = contacts(spark, sf_dir)
    key = F.substring("record", 2, 20).cast("long")
    fixed = spark.createDataFrame([(k,) for k in _KNOWN], "value string")
    known = rows.where(key % 7 == 0).select(F.col("mail").alias("value")).unionAll(rows.where(key % 5 == 0).select("phone")).unionAll(fixed)
    guard = pii.protect(rows, CONTACT_POLICY, "record", keys(spark), check_ids=False)
    sides = [("source", rows), ("serving", guard.serving)]
    out = [pii.leaks(df, known).withColumn("side", F.lit(side)) for side, df in sides]
    return out[0].unionByName(out[1])


@query("pii_value_lookup", "with " + _CONTACTS + """,
cells as (select case k % 4 when 0 then 'Call 0917 ' || a || ' ' || b || ' about it' when 1 then 'Write to ' || mail || ', TIN ' || a || '-456-789'
                 when 2 then 'No contact recorded' else '' end as remarks, segment from contacts),
texts as (select count(distinct t) as n from (select remarks as t from cells where remarks <> '' union all select segment from cells))
select count(*) as row_count, (select n from texts) as texts, (select n from texts) as calls, cast(sum(length(remarks) - length(replace(remarks, 'o', ''))) as bigint) as in_remarks,
       cast(sum(length(segment) - length(replace(segment, 'O', ''))) as bigint) as in_segments from cells""")
def pii_value_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A costly analyzer is called once for each distinct text of the table, however often a text stands in it."""
    calls = spark.sparkContext.accumulator(0)

    def analyze(text):
        calls.add(1)
        return [("PERSON", i, i + 1, 1.0) for i, c in enumerate(text) if c in "oO"]

    rows = contacts(spark, sf_dir).select("remarks", "segment")
    found = pii.looked_up(rows, ["remarks", "segment"], pii.udf_detector(analyze, pii.Policy()))
    distinct = rows.select(F.col("remarks").alias("t")).unionAll(rows.select("segment")).where("t <> ''").distinct()
    return found.agg(F.count("*").alias("row_count"), F.sum(F.size("remarks_spans")).alias("in_remarks"), F.sum(F.size("segment_spans")).alias("in_segments")).withColumns(
        {"texts": distinct.agg(F.count("*")).scalar(), "calls": F.lit(calls.value).cast("long")})


@query("tabular_pii", "with " + inputs.SILVER + f"""
select project_id, strftime(start_date, '%Y-%m-%d') as start_date, cast(budget_allocated_php as double) as budget_allocated_php,
       'vault:v1:' || to_base64(unhex(sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(principal_investigator)))))) as principal_investigator
from ranked where rn = 1""")
def tabular_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names hidden on the way into Bronze; Silver then works on pseudonyms."""
    from assaylake.catalogue import PROJECT_MONITORING
    from assaylake.plans import medallion

    policy = pii.policy_from({"scan": "declared_only", "columns": {"principal_investigator": {"serving": "pseudonymize"}}})
    staged = inputs.staged_projects(spark, sf_dir)
    safe = pii.protect(staged, policy, "project_id", keys(spark), check_ids=False).serving
    rows = medallion.latest_by(medallion.bronze(safe, PROJECT_MONITORING, inputs.RUN), ["project_id"], ["last_updated_at"], ["project_title"])
    return rows.select("project_id", day("start_date").alias("start_date"), dbl("budget_allocated_php").alias("budget_allocated_php"), "principal_investigator")


def _hidden_projects(spark: SparkSession, sf_dir: str):
    """Project rows that passed, protected and written the way a run does it."""
    policy = pii.policy_from({"scan": "declared_only", "columns": {"principal_investigator": {"serving": "pseudonymize"}}})
    rows = inputs.staged_projects(spark, sf_dir).filter(F.col("_validation_status") == "pass")
    return pii.protect(rows, policy, "project_id", keys(spark), check_ids=False).stored(scratch_dir(spark, "protected"))


@query("tabular_pii_vault", "with " + inputs.BRONZE + """
select project_id as record_id, 'principal_investigator' as column_name, principal_investigator as value from bronze""")
def tabular_pii_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run hid, revealed again from its vault."""
    return pii.revealed(_hidden_projects(spark, sf_dir).vault, keys(spark)).select("record_id", "column_name", "value")


@query("tabular_pii_findings", "with " + inputs.BRONZE + """
select 'principal_investigator' as "column", 'declared' as entity, count(*) as "count", 'pseudonymize' as treatment from bronze""")
def tabular_pii_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings a run keeps: counts per column, never the text."""
    return _hidden_projects(spark, sf_dir).findings.select("column", "entity", "count", "treatment")


@query("content_digests", "select doc_id, sha256(text) as sha256, substr(sha256(text), 1, 16) as short from documents")
def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from assaylake.functions.text import content_sha256

    return table(spark, sf_dir, "documents").select("doc_id", content_sha256(F.col("text")).alias("sha256"), content_sha256(F.col("text"), 16).alias("short"))


@query("pii_redact_columns", "with " + _CONTACTS + """
select record, '[REDACTED]' as mail, case when k % 4 = 3 then '' else '[REDACTED]' end as remarks, (select count(*) from contacts where k % 4 <> 3) as vault_rows from contacts""")
def pii_redact_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns redacted whole, one of them without a place in the vault."""
    policy = pii.policy_from({"scan": "declared_only", "columns": {"mail": {"serving": "redact", "vault": False}, "remarks": {"serving": "redact"}}})
    guard = pii.protect(contacts(spark, sf_dir), policy, "record", keys(spark), check_ids=False)
    return guard.serving.select("record", "mail", "remarks").withColumn("vault_rows", guard.vault.agg(F.count("*")).scalar())
