"""Plans and answers that must hold when one key owns a third of the rows."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from assaylake.operators import rules
from assaylake.operators.keys import first_k, key_counts, latest_by, with_copies
from assaylake.operators.rules import Rule
from assaylake.queries import QUERIES
from assaylake.queries.registry import table


def plan(df, mode="simple") -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def hot(spark, n=30000):
    """A third of the rows share one key, a third have none."""
    i = F.col("id")
    return spark.range(n).select(F.when(i % 3 == 0, "hot").when(i % 3 == 1, F.concat(F.lit("k"), i)).alias("k"), i.alias("v"))


def test_latest_is_cut_before_the_shuffle(spark):
    df = hot(spark)
    latest = latest_by(df.filter("k is not null"), ["k"], ["v"])
    text = plan(latest)
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert latest.filter("k = 'hot'").first()["v"] == 29997 and latest.count() == 10001
    assert "WindowGroupLimit" in plan(first_k(df, ["k"], [F.col("v")], 5))


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(key_counts(hot(spark), ["k"]))
    assert text.count("HashAggregate") == 2 and text.index("partial_count") > text.index("Exchange")


def test_rows_without_a_key_do_not_meet(spark):
    df = with_copies(hot(spark), ["k"])
    assert {(r["k"] == "hot", r["k"] is None, r["_copies"]): r["count"] for r in df.groupBy("k", "_copies").count().groupBy(
        "k", "_copies").agg(F.sum("count").alias("count")).filter("k is null or k = 'hot'").collect()} == {
        (True, False, 10000): 10000, (False, True, 0): 10000}
    # neither the hot key nor the rows without one gather in one place
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places = with_copies(hot(spark).repartition(8), ["k"]).withColumn("p", F.spark_partition_id())
        used = {r["k"]: r["n"] for r in places.filter("k is null or k = 'hot'").groupBy("k").agg(F.count_distinct("p").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert used[None] >= 6 and used["hot"] >= 6


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_equal_rows_stay_whole(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        equal_rows(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def equal_rows(spark):
    same = spark.range(20000).select(F.lit("x").alias("k"), F.lit(1).alias("v")).repartition(8)
    out = with_copies(same, ["k"]).groupBy("_copies").count().collect()
    assert [(r["_copies"], r["count"]) for r in out] == [(20000, 20000)]
    two = with_copies(hot(spark).withColumn("w", F.col("v") % 2), ["k", "w"])
    assert two.filter("k = 'hot'").select("_copies").distinct().first()[0] == 5000 and two.count() == 30000


def test_report_needs_no_join(spark):
    compiled = [Rule("unique", "k", unique=("k",)), Rule("odd", "v", fails=F.col("v") % 2 == 1)]
    report = rules.report(hot(spark), compiled, "x")
    assert "Join" not in plan(report)
    row = report.first()
    assert row["row_count"] == 30000 and row["flagged_rows"] == 10000 + 10000
    results = {r["rule"]: r for r in rules.rule_results(hot(spark), compiled, "v").collect()}
    assert results["unique"]["failed_count"] == 10000 and results["unique"]["sample_ids"] == ["hot"] * 5
    assert results["odd"]["failed_count"] == 15000 and len(results["odd"]["sample_ids"]) == 5
    two = [*compiled, Rule("unique", "v", unique=("v",))]
    again = {(r["rule"], r["column"]): r["failed_count"] for r in rules.rule_results(hot(spark), two, "v").collect()}
    assert again == {("unique", "k"): 10000, ("odd", "v"): 15000, ("unique", "v"): 0}


def test_scans_read_only_what_they_need(spark, sf):
    text = plan(QUERIES["identity_pass_through"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text
    gated = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    assert "LessThan(o_orderdate" in plan(gated)
    assert "CartesianProduct" not in "".join(plan(QUERIES[n](spark, sf)) for n in ("gold_rollup", "overlapping_extents", "profile_drift", "layer_trace"))


def test_archived_boxes_reach_the_reader(spark, sf):
    text = plan(QUERIES["geo_archive_box"](spark, sf), "formatted")
    assert "GreaterThanOrEqual(bbox.xmax" in text and "PartitionFilters: [isnotnull(layer" in text


def test_small_files_are_dealt_out(spark, sf):
    from assaylake.queries import privacy

    # one file, read by one task: the costly detection must not stay there
    cores = spark.sparkContext.defaultParallelism
    guard = privacy.pii.protect(privacy.contacts(spark, sf), privacy.CONTACT_POLICY, "record", privacy.keys(spark), check_ids=False)
    sizes = guard.vault.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= cores and max(r["count"] for r in sizes) <= sum(r["count"] for r in sizes) / cores


def test_a_key_is_read_once(spark):
    from assaylake.queries import privacy

    ring = privacy.keys(spark, newest=2)
    assert ring._enc_key(1) is ring._enc_key(1) and ring._enc_key(1) is not ring._enc_key(2)
