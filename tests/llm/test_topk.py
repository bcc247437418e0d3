"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from assaylake.llm.topk import top_k


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def truth(rows, every, k=10, scale=1024):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in whole:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, size string")


def result(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("kind", ["lengths", "unit", "few values"])
def test_top_k(spark, kind):
    rng = random.Random(kind)
    rows = []
    for i in range(400):
        v = [rng.gauss(0, 1) for _ in range(6)]
        scale = {"lengths": math.exp(rng.gauss(0, 1.5)), "unit": 1 / math.sqrt(sum(x * x for x in v)), "few values": 1.0}[kind]
        rows.append((i, [float(rng.randint(-1, 1)) for _ in v] if kind == "few values" else [_as_float(x * scale) for x in v]))
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, bucket_rows=37, block_rows=16)
    assert result(got) == truth(rows, 10)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def _as_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, None), (20, [1.0, None]), (30, [nan, 1.0]), (40, [inf, 1.0]), (50, [0.0, 0.0]), (60, [1.0, 2.0, 3.0]),
            (None, [1.0, 1.0]), (70, []), (80, []), (1, [1.0, 2.0]), (2, [-3.0, 0.5]), (3, [1.0, 2.0])]
    assert result(top_k(frame(spark, rows), F.col("vec_id") % 10 == 0)) == truth(rows, 10)
    assert top_k(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_registered_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in table.collect()]
    assert result(top_k(table, F.col("vec_id") % 100 == 0)) == truth(rows, 100)


def test_repeated_queries_and_candidates(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(40)]
    rows += [(0, rows[0][1]), (10, rows[10][1]), (10, [0.5, 0.25, -1.0, 2.0]), (7, rows[7][1]), (7, rows[7][1])]
    assert result(top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, block_rows=2, bucket_rows=8)) == truth(rows, 10)


def test_products_that_leave_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        top_k(frame(spark, [(0, [1e30, 0.0]), (1, [1e30, 1.0])]), F.col("vec_id") % 10 == 0).collect()
