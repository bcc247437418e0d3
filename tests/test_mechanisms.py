"""Distributed selection, leak search, detection in one pass, window counts, value lookup and polygons beside plain versions."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.functions import geo
from assaylake.functions import spans as sp
from assaylake.operators import pii
from assaylake.operators.polygons import overlapping_polygons
from assaylake.plans import reports
from assaylake.streaming import changes


@pytest.mark.parametrize("span_values", [1_000_000, 40])
def test_percentiles_by_selection(spark, span_values):
    rng = random.Random(4)
    rows = [("hot", rng.randint(0, 4000)) for _ in range(6000)] + [("two", 3), ("two", 8), ("one", 5), ("same", 7), ("same", 7), (None, 1), (None, 4), ("none", None)]
    got = reports.exact_percentiles(spark.createDataFrame(rows, "g string, v long"), ["g"], "v", (0.0, 0.5, 0.95, 1.0), span_values)
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    found = {r["g"]: [r[f"q{i}"] for i in range(4)] for r in got.collect()}
    assert found.keys() == groups.keys()
    for g, values in groups.items():
        assert np.allclose(found[g], np.quantile(values, (0.0, 0.5, 0.95, 1.0)))


def test_no_span_holds_a_group(spark, monkeypatch):
    seen = []
    keep = reports.stored

    def watched(df, name):
        out = keep(df, name)
        if name == "values":
            seen.append(out.groupBy("_id", "_span").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(reports, "stored", watched)
    rows = spark.range(20_000).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 20011).alias("v"))
    reports.exact_percentiles(rows, ["g"], "v", span_values=100).collect()
    assert seen[0] == 20_000 and seen[-1] <= 100


def test_leak_search_against_plain_search(spark):
    rng = random.Random(9)
    letters = "ab\u00e91 \n.*"
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    cells = list(zip(texts, texts[::-1]))
    for known in ([], ["", None], ["a"], ["ab", "\u00e91", "1 a", "aab", "*", "\n.", "b1b1b1b1", "zzz"], ["abab", "aba", "bab."], ["\U0001F389x"]):
        got = pii.leaks(spark.createDataFrame(cells, "a string, `b c` string"), spark.createDataFrame([(k,) for k in known], "value string"))
        want = {c: sum(any(k in t for k in known if k) for t in column if t) for c, column in zip(("a", "b c"), zip(*cells))}
        assert {r["column"]: r["cells"] for r in got.collect()} == want, known


def test_many_known_values_stay_off_the_driver(spark):
    known = spark.range(100_000).select(F.concat(F.lit("person."), "id", F.lit("@example.org")).alias("value"))
    rows = spark.createDataFrame([("write to person.77@example.org", "x"), ("person.100001@example.org", None), ("@example.org", "person.5@example.org,person.6@example.org")], "a string, b string")
    assert {r["column"]: r["cells"] for r in pii.leaks(rows, known).collect()} == {"a": 1, "b": 1}


def scored_spans(text, recognizer):
    out = []
    for m in re.finditer(recognizer.pattern, text):
        words = re.search(r"(?:\w+\W+){0,%d}\w*\Z" % sp.CONTEXT_WORDS, text[:m.start()]).group().lower()
        score = min(1.0, max(recognizer.score + sp.BOOST, sp.BOOST_FLOOR)) if recognizer.context and re.search("|".join(recognizer.context), words) else recognizer.score
        out.append((m.start(), m.end(), score))
    return out


def test_context_is_carried_along(spark):
    rng = random.Random(2)
    parts = ["tin ", "call ", "123-456-789", "0917 123 4567", "12345678901", " ", ", ", "word ", "gsis ", "mobile", "x" * 40, "\n", "tax-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(200)]
    for r in sp.REGIONAL_RECOGNIZERS:
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").withColumn("found", F.expr(sp._hits("text", r)))
        for row in rows.collect():
            assert [(s["start"], s["end"], s["score"]) for s in row["found"]] == scored_spans(texts[row["id"]], r), (r.name, texts[row["id"]])


def test_detection_grows_with_the_text(spark):
    def took(n):
        text = " ".join(f"mobile 0917 {i % 900 + 100} {i % 9000 + 1000}" for i in range(n))
        rows = spark.createDataFrame([(text,)], "text string").select(sp.detected("text").alias("s"))
        begin = time.time()
        assert rows.select(F.size("s")).first()[0] == n
        return time.time() - begin

    took(2000)
    few, many = min(took(2000) for _ in range(3)), min(took(8000) for _ in range(2))
    assert many < 4 * few + 2


def test_window_counts_equal_the_batch_whatever_the_order(spark, root):
    rows = [(f"2026-01-01 00:{m:02d}:30", op) for m, op in [(50, "c"), (51, "u"), (2, "c"), (3, "d"), (4, "c"), (58, "u"), (1, "c")]]
    rows = spark.createDataFrame(rows, "t string, op string").withColumn("t", F.to_timestamp("t"))
    for i, part in enumerate(("minute(t) >= 50", "minute(t) < 50")):
        rows.where(part).coalesce(1).write.parquet(f"{root}/in{i}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in*")
        changes.run_window_counts(stream, "t", "op", f"{root}/out", f"{root}/checkpoint", ["c", "u"]).awaitTermination()
    want = {(r["window_start"], r["op"]): r["n"] for r in changes.windowed_counts(rows, "t", "op", ["c", "u"]).collect()}
    assert {(r["window_start"], r["kind"]): r["n"] for r in changes.window_totals(spark, f"{root}/out").collect()} == want and len(want) == 4


def test_lookup_calls_once_for_each_text(spark):
    calls = spark.sparkContext.accumulator(0)

    def analyze(text):
        calls.add(1)
        return [("PERSON", 0, len(text), 1.0)]

    rows = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}", None if i % 2 else " ") for i in range(3000)], "id int, a string, b string").repartition(16)
    out = pii.looked_up(rows, ["a", "b"], pii.udf_detector(analyze, pii.Policy())).collect()
    assert calls.value == 1001 and len(out) == 3000
    assert all(r["a_spans"][0]["end"] == len(r["a"]) and r["b_spans"] == [] for r in out)


def shape(*rings, kind="Polygon"):
    return (kind, 4326, [[float(x) for x, _ in r] for r in rings], [[float(y) for _, y in r] for r in rings])


def square(x, y, s, turn=1):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)][::turn]


def test_polygons_that_share_area(spark):
    ring = [(round(50 + 10 * math.cos(k / 100 * math.tau), 9), round(10 * math.sin(k / 100 * math.tau), 9)) for k in range(100)]
    rows = {
        1: shape(square(0, 0, 2)), 2: shape(square(2, 0, 2)),  # share a border
        3: shape(square(10, 0, 4), square(11, 1, 2)), 4: shape(square(11, 1, 2)),  # fills the hole
        5: shape(square(20, 0, 4, -1), square(21, 1, 2)), 6: shape(square(22, 2, 2)),  # reaches beyond the hole; shell runs with the clock
        7: shape(square(30, 0, 2)), 8: shape(square(30, 0, 2)),  # equal
        9: shape([(40, 0), (42, 2), (40, 4), (38, 2), (40, 0)]), 10: shape(square(38, 0, 4)),  # touches from inside at corners only
        11: shape([*ring, ring[0]]), 12: shape(square(49, -1, 2)), 13: shape(square(60.5, 0, 1)),  # far smaller inside; outside
        14: shape(square(70, 0, 1), square(80, 0, 1), kind="MultiPolygon"), 15: shape(square(80, 0, 1)), 16: shape(square(75, 0, 1)),
        17: shape([(90, 0), (94, 0), (90, 4), (90, 0)]), 18: shape([(94, 4), (94, 1), (91, 4), (94, 4)]),  # rectangles meet, areas do not
        19: None, 20: shape([(1, 1)], kind="Point"), 21: shape([(5, 5), (6, 6), (5, 5)]),
    }
    table = spark.createDataFrame(list(rows.items()), f"id long, geom {geo.SHAPE_TYPE.simpleString()}")
    assert {r["id"] for r in overlapping_polygons(table, "id").collect()} == {5, 6, 7, 8, 9, 10, 11, 12, 14, 15}
    plan = overlapping_polygons(table, "id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_crowded_polygons_meet_few_partners(spark, monkeypatch):
    from assaylake.operators import polygons

    rng = random.Random(5)
    halves = [(rng.random() < .5, rng.randrange(320) / 8, rng.randrange(320) / 8, rng.randrange(2, 13)) for _ in range(1500)]
    halves += [(lower, 100 + 20 * i, 0, 5) for i in range(50) for lower in (True, False)]  # extents are equal, areas are apart

    def meet(a, b):
        if a[0] and b[0]:
            return max(a[1], b[1]) + max(a[2], b[2]) < min(sum(a[1:]), sum(b[1:]))
        if not a[0] and not b[0]:
            return min(a[1] + a[3], b[1] + b[3]) + min(a[2] + a[3], b[2] + b[3]) > max(sum(a[1:]), sum(b[1:]))
        low, up = (a, b) if a[0] else (b, a)
        return low[1] < up[1] + up[3] and low[2] < up[2] + up[3] and max(sum(up[1:]), low[1] + low[2]) < min(sum(low[1:]), sum(up[1:]) + up[3])

    want = {i for i, a in enumerate(halves) if any(j != i and meet(a, b) for j, b in enumerate(halves))}
    rows = [(i, shape([(x, y), (x + s, y), (x, y + s), (x, y)] if lower else [(x + s, y), (x, y + s), (x + s, y + s), (x + s, y)]))
            for i, (lower, x, y, s) in enumerate(halves)]
    pairs, areas = [], polygons.shared_areas
    monkeypatch.setattr(polygons, "shared_areas", lambda p, *rest: pairs.append(p.count()) or areas(p, *rest))
    table = spark.createDataFrame(rows, f"id long, geom {geo.SHAPE_TYPE.simpleString()}")
    assert {r["id"] for r in overlapping_polygons(table, "id").collect()} == want
    assert 1400 < len(want) < 1600 and sum(pairs) < 4 * len(rows)
    # with one partner a turn most are left to the last one
    monkeypatch.setattr(polygons, "TRIES", (1,))
    assert {r["id"] for r in overlapping_polygons(table, "id").collect()} == want


def test_overlaps_of_polygons_pass_no_table_through_the_driver(spark, monkeypatch):
    from assaylake.operators import polygons

    plans, stored = [], polygons.stored
    monkeypatch.setattr(polygons, "TRIES", (2,))
    monkeypatch.setattr(polygons, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or stored(df, name))
    # two overlap, two are equal, two stay open until the last turn: their extents meet, they do not
    rows = {1: shape(square(0, 0, 2)), 2: shape(square(1, 1, 2)), 3: shape(square(9, 0, 1)), 4: shape(square(9, 0, 1)),
            5: shape([(20, 0), (25, 0), (20, 5), (20, 0)]), 6: shape([(25, 1), (21, 5), (25, 5), (25, 1)]), 7: None}
    table = spark.createDataFrame(list(rows.items()), f"id long, geom {geo.SHAPE_TYPE.simpleString()}")
    got = overlapping_polygons(table, "id")
    plans.append(("result", got._jdf.queryExecution().toString()))
    assert {r["id"] for r in got.collect()} == {1, 2, 3, 4}
    assert [name for name, _ in plans].count("still-open") == 2
    # however small the files are
    assert [name for name, plan in plans if "Broadcast" in plan] == []
    assert all("SortMergeJoin" in plan for name, plan in plans if name in ("open-pairs", "overlapping", "still-open", "result"))


def test_overlapping_spans_are_joined(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        spans = []
        for _ in range(rng.choice([0, 1, 2, 9, 30])):
            start = rng.randint(0, 60)
            spans.append((rng.choice("AB"), start, start + rng.randint(1, 9), rng.choice([0.4, 0.6, 0.95])))
        rows.append((i, spans))
    got = spark.createDataFrame(rows, f"id int, s {sp.SPANS_TYPE}").select("id", sp.merged("s").alias("m")).collect()
    for row in got:
        want = []
        for e, s, t, v in sorted(rows[row["id"]][1], key=lambda x: (x[1], -x[3], x[2], x[0])):
            if want and s < want[-1][2]:
                last = want[-1]
                want[-1] = (last[0] if last[3] >= v else e, last[1], max(last[2], t), max(last[3], v))
            else:
                want.append((e, s, t, v))
        assert [tuple(x) for x in row["m"]] == want


def test_problems_of_polygons(spark):
    from assaylake.operators.polygons import polygon_problems

    ring = [(round(10 * math.cos(k / 400 * math.tau), 9), round(10 * math.sin(k / 400 * math.tau), 9)) for k in range(400)]
    star = ring[:200] + [(-30.0, 0.5), (30.0, 0.6)] + ring[200:]  # a spike through the whole shape
    shapes = {
        "fine": shape(square(0, 0, 2)), "few": shape([(0, 0), (1, 1), (0, 0)]), "open": shape([(0, 0), (1, 0), (1, 1), (0, 1)]),
        "line": shape([(0, 0), (1, 1), (2, 2), (0, 0)]), "bow": shape([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]),
        "twice": shape([(0, 0), (1, 0), (1, 0), (1, 1), (0, 0)]), "round": shape([*ring, ring[0]]), "spike": shape([*star, star[0]]),
        "hole": shape(square(0, 0, 4), square(1, 1, 2)), "touch": shape(square(0, 0, 4), [(0, 2), (1, 1), (1, 3), (0, 2)]),
        "cut": shape(square(0, 0, 4), square(3, 1, 2)), "border": shape(square(0, 0, 4), square(0, 1, 2)), "away": shape(square(0, 0, 4), square(9, 9, 2)),
        "around": shape(square(1, 1, 1), square(0, 0, 4)), "bad hole": shape(square(0, 0, 4), [(1, 1), (2, 2), (2, 1), (1, 2), (1, 1)]),
        "parts": shape(square(0, 0, 1), square(5, 5, 1), kind="MultiPolygon"), "round hole": shape([*ring, ring[0]], square(-1, -1, 2)),
        "far hole": shape([*ring, ring[0]], square(9, 9, .5)), "point": shape([(1, 1)], kind="Point"), "none": None,
    }
    table = spark.createDataFrame(list(shapes.items()), f"id string, geom {geo.SHAPE_TYPE.simpleString()}")
    got = {r["id"]: r["problem"] for r in polygon_problems(table, "id").collect()}
    want = {"few": "too_few_points", "open": "ring_not_closed", "line": "self_crossing", "bow": "self_crossing", "spike": "self_crossing", "cut": "rings_cross",
            "border": "rings_cross", "away": "hole_outside", "around": "hole_outside", "bad hole": "self_crossing", "far hole": "hole_outside"}
    old = {r["id"]: r["p"] for r in table.select("id", geo.shape_problem(F.col("geom")).alias("p")).collect() if r["p"]}
    assert {i: p for i, p in got.items() if p in ("rings_cross", "hole_outside")} == {i: p for i, p in want.items() if p in ("rings_cross", "hole_outside")}
    assert {i: p for i, p in got.items() if p not in ("rings_cross", "hole_outside")} == old


def test_bucketed_silver_is_not_shuffled(spark, root):
    from assaylake.operators.keys import latest_by
    from assaylake.sinks import staging

    rows = spark.range(500).select((F.col("id") % 90).alias("k"), F.col("id").alias("v"))
    staging.write_bucketed(rows, "bucketed_rows", f"{root}/rows", ["k"], 4)
    table = spark.table("bucketed_rows")
    latest = latest_by(table, ["k"], ["v"], [])
    out = latest.join(table.groupBy("k").agg(F.count("*").alias("n")), "k")
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r["k"], r["v"], r["n"]) for r in out.collect()} == {(k, max(range(k, 500, 90)), len(range(k, 500, 90))) for k in range(90)}


def test_content_digest_knows_no_order(spark):
    from assaylake.functions.text import content_digest, row_text

    rows = spark.createDataFrame([("a", None), ("b", 2), ("b", 2), (None, 3)], "s string, n int")
    text = row_text(F.col("s"), F.col("n"))
    digest = [df.agg(content_digest(text)).first()[0] for df in (rows, rows.orderBy(F.desc("n")).repartition(7), rows.distinct(), spark.createDataFrame([("a", 1)], "s string, n int"))]
    assert digest[0] == digest[1] and len(set(digest)) == 3


def test_retention_removes_partitions_once(spark, root):
    from assaylake.sinks import staging

    rows = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-01"), (3, "2026-01-20"), (4, "2026-02-01")], "v int, day string")
    rows.write.partitionBy("day").parquet(f"{root}/quarantine")
    rows.where("v < 3").write.partitionBy("day").parquet(f"{root}/archive")
    tiers = {f"{root}/quarantine": 14, f"{root}/archive": 90, f"{root}/never": 1}
    gone = staging.retained(spark, tiers, "2026-02-05", f"{root}/log").collect()
    assert sorted((r["day"], r["row_count"]) for r in gone) == [("2026-01-01", 2), ("2026-01-20", 1)]
    assert [r["v"] for r in spark.read.parquet(f"{root}/quarantine").collect()] == [4] and spark.read.parquet(f"{root}/archive").count() == 2
    assert staging.retained(spark, tiers, "2026-02-05", f"{root}/log").count() == 0
    assert staging.retained(spark, tiers, "2026-05-05", f"{root}/log").count() == 2
    assert staging.retained(spark, tiers, "2026-05-05", f"{root}/log").count() == 0 and spark.read.parquet(f"{root}/log").count() == 4


def test_problems_need_no_broadcast_of_shapes(spark, monkeypatch):
    from assaylake.operators import polygons

    rng = random.Random(5)
    shapes = []
    for i in range(120):
        corners = [(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(rng.choice([3, 4, 5, 9]))]
        hole = square(rng.randint(-1, 6), rng.randint(0, 5), rng.choice([.5, 1, 2]))
        shapes.append((i, shape([*corners, corners[0]], *([hole] if i % 2 else []), kind="MultiPolygon" if i % 7 == 0 else "Polygon")))
    shapes += [(200 + i, shape(square(0, 0, 4), square(x, 1, 2))) for i, x in enumerate((1, 2, 3, 4, 9))]
    table = spark.createDataFrame(shapes, f"id long, geom {geo.SHAPE_TYPE.simpleString()}")
    plain = polygons.polygon_problems(table, "id")
    within = {r["id"]: r["problem"] for r in plain.collect()}
    monkeypatch.setattr(polygons, "FEW_SEGMENTS", 0)
    by_cells = polygons.polygon_problems(table, "id")
    assert within == {r["id"]: r["problem"] for r in by_cells.collect()} and len(set(within.values())) > 3
    for found in (plain, by_cells):  # tables stored under way are small in files only
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().toString()


def test_known_values_meet_few_cells(spark, monkeypatch):
    from assaylake.operators import pii

    kept = {}
    store = pii.stored
    monkeypatch.setattr(pii, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    ids = spark.range(20000).select(F.concat(F.lit("person."), F.col("id") + 100000, F.lit("@example.org")).alias("mail"))
    assert pii.leaks(ids, ids.where("mail like '%7@%'")).collect()[0]["cells"] == 2000
    pairs = kept["held"].join(kept["rarest"], "gram").count()
    assert 2000 <= pairs <= 20000  # with shorter pieces a value meets hundreds of cells
