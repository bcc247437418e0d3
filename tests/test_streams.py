import json
import os
import re

import pytest

from pyspark.sql import functions as F

from assaylake.sources import records
from assaylake.streaming import changes

COLUMNS = ["k", "v"]


def event(op, key, at, value=None):
    image = {"k": key, "v": value}
    return json.dumps({"op": op, ("before" if op == "d" else "after"): image, "ts_ms": at, "source": {"table": "t"}})


def feed(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write("\n".join(lines) + "\n")


def step(spark, root, state):
    changes.run_state(changes.file_changes(spark, root + "/in", COLUMNS), COLUMNS, state, root + "/checkpoint").awaitTermination()
    return {r["k"]: r["v"] for r in state.current().collect()}


def test_state_over_several_runs(spark, root):
    state = changes.StateTable(spark, root + "/state", ["k"])
    feed(root + "/in", "1.json", [event("c", "a", 1, "a1"), event("c", "b", 1, "b1"), event("u", "a", 3, "a3"), event("u", "a", 2, "a2")])
    assert step(spark, root, state) == {"a": "a3", "b": "b1"}
    feed(root + "/in", "2.json", [event("d", "b", 5), event("c", "c", 4, "c4")])
    assert step(spark, root, state) == {"a": "a3", "c": "c4"}
    assert state.compact() == 1
    # an older event arrives late: the deleted key stays deleted, the newer value stays
    feed(root + "/in", "3.json", [event("u", "b", 4, "b4"), event("u", "a", 2, "late")])
    assert step(spark, root, state) == {"a": "a3", "c": "c4"}
    assert state.compact() == 2 and state.compact() == 2
    feed(root + "/in", "4.json", [event("c", "b", 9, "b9")])
    assert step(spark, root, state) == {"a": "a3", "b": "b9", "c": "c4"}
    # a repeated micro batch replaces itself
    batch = spark.createDataFrame([("z", "z1", "c", "t", 1)], "k string, v string, _cdc_operation string, _source_table string, _operation_timestamp bigint")
    state.absorb(batch, 77)
    state.absorb(batch, 77)
    assert spark.read.parquet(root + "/state/log").filter("_epoch = 77").count() == 1


def test_a_new_checkpoint_keeps_older_runs_and_snapshots_are_read(spark, root):
    state = changes.StateTable(spark, root + "/state", ["k"])
    feed(root + "/in", "1.json", [event("c", "a", 1, "a1"), event("c", "b", 1, "b1")])
    assert step(spark, root, state) == {"a": "a1", "b": "b1"}
    assert state.compact() == 1
    feed(root + "/later", "1.json", [event("c", "c", 2, "c2"), event("u", "b", 3, "b3")])
    changes.run_state(changes.file_changes(spark, root + "/later", COLUMNS), COLUMNS, state, root + "/other").awaitTermination()
    assert {r["k"]: r["v"] for r in state.current().collect()} == {"a": "a1", "b": "b3", "c": "c2"}
    # the first run's only epoch is in the snapshot, so its partition is skipped
    plan = state.current()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*_epoch#\d+", plan)
    assert state.compact() == 2


def test_events_of_one_table(spark):
    raw = spark.createDataFrame([(event("c", "a", 1, "x"),), (json.dumps({"op": "c", "after": {"k": "b"}, "table": "u"}),)], "value string")
    parsed = changes.parse_changes(raw, COLUMNS)
    assert changes.for_table(parsed, "u").count() == 1 and changes.for_table(parsed, "t").count() == 1


def test_cursor_on_empty_state(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert changes.since_cursor(df, "c", df.limit(0)).count() == 2
    assert changes.since_cursor(df, "c", df.filter("c = 1")).count() == 1


def test_landing_values(spark):
    df = spark.createDataFrame([("d", 3)], "dataset string, rows int")
    row = changes.landing_stream(df, "dataset").first()
    assert row["key"] == "d" and json.loads(row["value"]) == {"dataset": "d", "rows": 3}
    counted = changes.windowed_counts(spark.createDataFrame([("2026-01-01 00:01:00", "c")], "t string, op string").withColumn("t", F.to_timestamp("t")), "t", "op")
    assert counted.first()["n"] == 1


def test_broken_events_end_the_query_unless_kept(spark):
    raw = spark.createDataFrame([(event("c", "a", 1, "x"),), ("{broken",), ("[1]",), (json.dumps({"op": "c", "after": {"k": "b"}, "ts_ms": "2026-01-01T00:00:00Z"}),), (None,)], "value string")
    kept = changes.parse_changes(raw, COLUMNS, on_broken="keep").collect()
    assert [r["_broken"] is None for r in kept] == [True, False, False, False] and kept[0]["after"]["k"] == "a" and kept[1]["after"] is None
    with pytest.raises(Exception, match="broken change event"):
        changes.parse_changes(raw, COLUMNS).collect()
    pages = spark.createDataFrame([('{"data": {"records": [{"k": "a"}]}}',), ('[{"k": "b"}]',), ('{"data": {"records": [{"k": "c"',), ('{"items": []}',)], "value string")
    rows = records.explode_records(pages, COLUMNS, on_broken="keep").collect()
    assert sorted(r["k"] for r in rows if r["_broken"] is None) == ["a", "b"] and sum(r["_broken"] is not None for r in rows) == 2
    with pytest.raises(Exception, match="broken payload"):
        records.explode_records(pages, COLUMNS).collect()
