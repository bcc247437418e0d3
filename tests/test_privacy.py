import hashlib
import hmac
import json
import re
from base64 import b64encode

import pytest
from pyspark.sql import functions as F

from assaylake.functions import spans as sp
from assaylake.functions.crypto import KeyRing, MissingKey, key_version
from assaylake.functions.text import mask_digits_keep3, mask_text
from assaylake.operators import pii
from assaylake.sinks import catalog
from tests.fixtures import PEOPLE, PEOPLE_COLUMNS, PEOPLE_POLICY, SECRETS

HMAC = b"a secret for tests"
ENC = {1: b"0123456789abcdef"}


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, PEOPLE_COLUMNS)


@pytest.fixture
def ring(spark):
    return KeyRing(spark, HMAC, ENC)


@pytest.fixture
def guard(people, ring, root):
    return pii.protect(people, pii.policy_from(PEOPLE_POLICY), "feature_id", ring).stored(root + "/protected")


def test_serving_copy(people, guard):
    rows = {r["feature_id"]: r.asDict() for r in guard.serving.collect()}
    blob = json.dumps(list(rows.values()))
    assert not [s for s in SECRETS if s in blob]
    for before in people.collect():
        assert all(rows[before["feature_id"]][c] == before[c] for c in ("name", "address", "region"))
    assert rows["p5"]["contact_person"] == rows["p7"]["contact_person"] != rows["p2"]["contact_person"]
    assert rows["p5"]["contact_email"] == "a***@clinic.example.org" and rows["p2"]["contact_phone"] == "**** *** *199"
    assert rows["p2"]["remarks"] == "Second desk: <PERSON>, phone <PH_PHONE>; tin <PH_TIN>"
    assert rows["p5"]["remarks"] == "Parcels for SSS <PH_SSS> go upstairs" and rows["p9"]["remarks"] == "Copies to <EMAIL_ADDRESS>"
    assert rows["p3"]["remarks"] == "" and rows["p7"]["remarks"] == "Closed on Mondays"


def test_pseudonym_is_a_keyed_hash(people, ring):
    out = people.select("contact_person", ring.pseudonym(F.col("contact_person")).alias("p")).collect()
    for row in out:
        digest = hmac.new(HMAC, row["contact_person"].encode(), hashlib.sha256).digest()
        assert row["p"] == "vault:v1:" + b64encode(digest).decode()
    long_key = b"k" * 100
    one = people.select(KeyRing(people.sparkSession, long_key, ENC).pseudonym(F.lit("x"))).first()[0]
    assert one == "vault:v1:" + b64encode(hmac.new(long_key, b"x", hashlib.sha256).digest()).decode()
    assert people.select(ring.pseudonym(F.lit(""))).first()[0] is None


def test_vault(people, guard, ring):
    vault = guard.vault.collect()
    assert len(vault) == 19 and all(v["ciphertext"].startswith("vault:v1:") and v["key_version"] == 1 for v in vault)
    open_ = {(r["record_id"], r["column_name"]): r["value"] for r in pii.revealed(guard.vault, ring).collect()}
    for row in people.collect():
        for c in ("contact_person", "contact_phone", "contact_email"):
            assert open_[(row["feature_id"], c)] == row[c]
    assert open_[("p9", "remarks")] == "Copies to desk@ferry.example.net"
    assert open_[("p2", "remarks")] == "Second desk: Atty. Luz Vera, phone 0928 777 1234; tin <PH_TIN>"
    assert ("p3", "remarks") not in open_
    some = pii.revealed_by_record(guard.vault, ring, ["p5"], ["contact_email"]).collect()
    assert [(r["record_id"], r["contacts"]) for r in some] == [("p5", {"contact_email": "amihan@clinic.example.org"})]


def test_findings_hold_no_text(guard):
    found = [r.asDict() for r in guard.findings.collect()]
    assert not [s for s in SECRETS if s in json.dumps(found)]
    by = {(r["column"], r["entity"]): r for r in found}
    assert by[("contact_person", "declared")]["count"] == 5 and by[("remarks", "declared")]["count"] == 4
    assert by[("remarks", "PH_TIN")]["max_score"] == 0.95  # 'tin' right before it
    tags = {r["column"]: r["tag"] for r in catalog.column_tags(guard.findings).collect()}
    assert tags == {"contact_person": "pii_pseudonymized", "contact_email": "pii_masked", "contact_phone": "pii_masked", "remarks": "pii_text_redacted"}
    stats = guard.stats.first()
    assert stats["rows"] == 5 and stats["vault_rows"] == 19
    assert stats["columns_protected"] == ["contact_email", "contact_person", "contact_phone", "remarks"]


def test_second_scan_finds_nothing(guard):
    assert pii.rescanned(guard.serving).count() == 0
    assert all(r["cells"] == 0 for r in pii.leaks(guard.serving, SECRETS).collect())


def test_roles_and_missing_keys(spark, people, guard, ring):
    policy = pii.policy_from(PEOPLE_POLICY)
    writer, reader = KeyRing(spark, HMAC, ENC, can_decrypt=False), KeyRing(spark, None, ENC, can_encrypt=False)
    with pytest.raises(PermissionError):
        pii.revealed(guard.vault, writer)
    with pytest.raises(PermissionError):
        pii.protect(people, policy, "feature_id", KeyRing(spark, HMAC, ENC, can_encrypt=False))
    assert pii.revealed(guard.vault, reader).count() == 19
    with pytest.raises(MissingKey):
        pii.protect(people, policy, "feature_id", KeyRing(spark, None, ENC))
    with pytest.raises(MissingKey):
        pii.protect(people, policy, "feature_id", KeyRing(spark, HMAC))
    wrong = KeyRing(spark, HMAC, {1: b"another key 0000"})
    assert pii.revealed(guard.vault, wrong).filter("value is not null").count() == 0


def test_keys_stay_out_of_plans(guard, people, spark):
    ring = KeyRing(spark, b"HMACKEYMATERIAL", {1: b"ENCKEYMATERIAL00"})
    plan = pii.protect(people, pii.policy_from(PEOPLE_POLICY), "feature_id", ring).rows._jdf.queryExecution().toString()
    assert "HMACKEYMATERIAL" not in plan and "ENCKEYMATERIAL00" not in plan
    assert b64encode(b"ENCKEYMATERIAL00").decode() not in plan and b"ENCKEYMATERIAL00".hex().upper() not in plan.upper()


def test_rotation_and_erasure(spark, guard):
    newer = KeyRing(spark, HMAC, {1: ENC[1], 2: b"fedcba9876543210"})
    fresh = pii.rotated(guard.vault, newer)
    assert {r["key_version"] for r in fresh.collect()} == {2}
    only_new = KeyRing(spark, HMAC, {2: b"fedcba9876543210"})
    assert pii.revealed(fresh, only_new, ["p5"], ["contact_person"]).first()["value"] == "Amihan Soriano"
    gone = pii.erased(guard.vault, spark.createDataFrame([("p5",)], "id string"))
    assert gone.filter("record_id = 'p5'").count() == 0 and gone.count() == 15
    assert fresh.select(key_version(F.col("ciphertext"))).distinct().count() == 1


def test_record_ids_must_be_usable(spark, people, ring):
    policy = pii.policy_from(PEOPLE_POLICY)
    with pytest.raises(ValueError):
        pii.protect(people.union(people), policy, "feature_id", ring)
    with pytest.raises(ValueError):
        pii.protect(people.withColumn("feature_id", F.lit(None).cast("string")), policy, "feature_id", ring)
    with pytest.raises(ValueError):
        pii.protect(people, policy, "no_such_column", ring)


@pytest.mark.parametrize("config", [
    {"scan": "some"}, {"score_threshold": 2}, {"columns": {"a": {"serving": "shred"}}}, {"columns": {"a": {}}},
    {"columns": {"a": {"serving": "mask", "x": 1}}}, {"unknown": 1}, {"on_unreachable_key_service": "continue"}])
def test_bad_policies(config):
    with pytest.raises(ValueError):
        pii.policy_from(config)


def test_vault_false_redact_and_declared_only(people, ring):
    policy = pii.policy_from({"scan": "declared_only", "columns": {
        "contact_person": {"serving": "redact", "vault": False}, "contact_email": {"serving": "mask"}}})
    out = pii.protect(people, policy, "feature_id", ring)
    assert {r[0] for r in out.serving.select("contact_person").collect()} == {"[REDACTED]"}
    assert {r["column_name"] for r in out.vault.collect()} == {"contact_email"}
    assert out.serving.filter("feature_id = 'p2'").first()["remarks"] == PEOPLE[0][-1]
    with pytest.raises(ValueError):
        pii.protect(people, pii.policy_from({"columns": {"nope": {"serving": "mask"}}}), "feature_id", ring)
    with pytest.raises(ValueError):
        pii.protect(people, pii.policy_from({"skip_columns": ["remarks"], "columns": {"remarks": {"serving": "mask"}}}), "feature_id", ring)


def test_pluggable_analyzer(people, ring):
    def analyze(text):
        return [("PERSON", m.start(), m.end(), 0.9) for m in re.finditer("Mondays|Parcels", text)] + [("PERSON", 0, 4, 0.1)]

    policy = pii.policy_from({"skip_columns": ["name", "address"], "columns": {}})
    out = pii.protect(people, policy, "feature_id", ring, pii.udf_detector(analyze, policy))
    rows = {r["feature_id"]: r["remarks"] for r in out.serving.collect()}
    assert rows["p7"].endswith("on <PERSON>") and rows["p5"].startswith("<PERSON> for SSS")


def _merged_by_hand(spans):
    done = []
    for entity, start, end, score in sorted(spans, key=lambda s: (s[1], -s[3], s[2], s[0])):
        if done and start < done[-1][2]:
            last = done[-1]
            name = last[0] if last[3] >= score else entity
            done[-1] = (name, last[1], max(last[2], end), max(last[3], score))
        else:
            done.append((entity, start, end, score))
    return done


TEXTS = [
    "Call 0917-123-4567 or +63 917 123 4567", "landline (02) 8123 4567, office 02 8123 4567", "PhilSys 1234-5678-9012-3456",
    "gsis 12345678901 and one two three four five 12345678901", "tax 123-456-789-12345", "SSS 12-3456789-0 and a.b+c@mail.example.com.",
    "phone +1 (555) 123-4567", "Dr. A. Cruz met Ms. Ana de la Paz", "ñandú é 0917 123 4567 ü", "", "nothing here", "00639171234567890",
]


def test_spans_against_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r["id"]: [tuple(s) for s in r["s"]] for r in df.select("id", sp.detected("text").alias("s")).collect()}
    for i, text in enumerate(TEXTS):
        raw = []
        for r in sp.DEFAULT_RECOGNIZERS:
            for m in re.finditer(r.pattern, text, re.ASCII):
                before = text[max(0, m.start() - 256):m.start()]
                words = re.search(r"(?:\w+\W+){0,5}\w*$", before, re.ASCII).group().lower()
                boosted = any(c in words for c in r.context)
                score = min(1.0, max(r.score + 0.35, 0.4)) if boosted else r.score
                if score >= 0.4:
                    raw.append((r.entity, m.start(), m.end(), score))
        assert got[i] == _merged_by_hand(raw), text
    assert [s[0] for s in got[3]] == ["PH_GSIS"]  # only the one named right before it reaches the threshold


def test_odd_column_names(spark, ring):
    df = spark.createDataFrame([("1", "mail a@b.example.org")], ["id", "it's `odd`"])
    out = pii.protect(df, pii.Policy(), "id", ring)
    assert out.serving.first()[1] == "mail <EMAIL_ADDRESS>" and out.findings.first()["column"] == "it's `odd`"


def test_masks(spark):
    cases = ["juan@example.org", "@x.org", "Juan", "", "0917 123 4567", "12", "123", "1234", "no digits"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    out = {r["t"]: (r["m"], r["d"]) for r in df.select("t", mask_text(F.col("t")).alias("m"), mask_digits_keep3(F.col("t")).alias("d")).collect()}
    assert [out[c][0] for c in cases[:3]] == ["j***@example.org", "***@x.org", "J***"]
    assert [out[c][1] for c in cases[4:]] == ["**** *** *567", "**", "***", "*234", "no digits"]
