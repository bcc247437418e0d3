"""Exact top-k inner products with candidates in buckets of similar length.

* Components are taken as whole numbers: ``floor(scale * x)`` in double precision; scores are exact integers.
* Vectors are bucketed by number of components and length (steps of ten per cent); a bucket that would hold more than
  ``bucket_rows`` is split at random, so equal lengths - normalised vectors, copies - never fill one task.
* First each query meets the longest bucket; its k-th score there bounds what can still enter its answer.
* That bound, over the lengths of query and bucket, is a local cosine threshold. Above one the bucket is skipped.
  Else the bucket is pruned by coordinates (the query's largest coordinates confine those of any vector above
  the threshold) or, where the threshold is too low for that, by length. What is left is verified exactly.
* Queries meet buckets in blocks of ``block_rows``, as the query set grows with the table.

Vectors that are null or hold null or non-finite components take no part, as queries or as candidates; vectors
of different sizes do not meet. A row is no candidate of its own ``vec_id``. Ties go to the smaller ``vec_id``. Repeated rows are
queries, and candidates, each on their own. Vectors so long that a product could leave 64 bits end the query with an error.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP = 1.1
FOCUS = 3  # coordinates looked at
COORDINATE_FROM = 0.3  # local cosine threshold from which coordinates prune better than length
LONGEST = 3.0e9  # of a vector of whole numbers
_SLACK = 1e-9


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dim, v, size): usable vectors as whole numbers, with their Euclidean length."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    own = (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
           .select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), v.alias("v"))
           .withColumn("size", F.sqrt(squares)))
    # no product exceeds that of two lengths
    too_long = F.raise_error(F.concat(F.lit("products of vector "), "vec_id", F.lit(" may leave 64 bits"))).cast("double")
    return own.withColumn("size", F.when(F.col("size") < LONGEST, F.col("size")).otherwise(too_long))


def best_in_bucket(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                   floors: np.ndarray, k: int):
    """For each query its best k of one bucket, nothing below its floor: (query row, ids, scores)."""
    lengths = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    ids, matrix, lengths = ids[order], matrix[order], lengths[order]
    unit = matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
    ranked = np.argsort(unit, axis=0)  # by coordinate
    values = np.take_along_axis(unit, ranked, axis=0)
    for row, (own, query, floor) in enumerate(zip(query_ids, queries, floors)):
        length = float(np.sqrt((query.astype(float) ** 2).sum()))
        local = floor / (length * lengths[0]) if length * lengths[0] > 0 else (-1.0 if floor <= 0 else 2.0)
        if local > 1 + _SLACK:
            continue
        if local >= COORDINATE_FROM:
            direction = query / length
            focus = np.argsort(-np.abs(direction))[:FOCUS]
            room = np.sqrt(max(0.0, 1 - local * local)) * np.sqrt(np.maximum(0.0, 1 - direction[focus] ** 2))
            low, high = direction[focus] * local - room - _SLACK, direction[focus] * local + room + _SLACK
            # a longer reach in the same direction only raises the cosine
            whole = np.abs(direction[focus]) >= local
            low = np.where(whole & (direction[focus] < 0), -1 - _SLACK, low)
            high = np.where(whole & (direction[focus] > 0), 1 + _SLACK, high)
            begin = [np.searchsorted(values[:, f], a, "left") for f, a in zip(focus, low)]
            end = [np.searchsorted(values[:, f], b, "right") for f, b in zip(focus, high)]
            first = int(np.argmin(np.subtract(end, begin)))
            found = ranked[begin[first]:end[first], focus[first]]
            for f, a, b in zip(focus, low, high):
                found = found[(unit[found, f] >= a) & (unit[found, f] <= b)]
        elif floor > 0:
            found = np.arange(np.searchsorted(-lengths, -(floor / length) * (1 - _SLACK), "right"))
        else:
            found = np.arange(len(ids))
        found = found[ids[found] != own]
        scores = matrix[found] @ query
        keep = scores >= floor
        found, scores = ids[found[keep]], scores[keep]
        top = np.lexsort((found, -scores))[:k]
        yield row, found[top], scores[top]


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _met(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(ask, query_id, vec_id, score): the best k of each query in each (bucket, block) both sides share."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            asked, number = np.asarray(left.column("query_id")), np.asarray(left.column("ask"))
            for row, ids, scores in best_in_bucket(
                    np.asarray(right.column("vec_id")), _matrix(right.column("v")), asked, _matrix(left.column("q")),
                    np.asarray(left.column("floor")), k):
                for column, values in zip(out, (np.full(len(ids), number[row]), np.full(len(ids), asked[row]), ids, scores)):
                    column.append(values)
        arrays = [pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in out]
        return pa.table(arrays, ["ask", "query_id", "vec_id", "score"])

    keys = ["dim", "class", "part", "block"]
    return (queries.select(*keys, "ask", "query_id", "q", "floor").groupBy(*keys)
            .cogroup(candidates.select(*keys, "vec_id", "v").groupBy(*keys))
            .applyInArrow(run, "ask long, query_id long, vec_id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, asked: Column, k: int = 10, *, scale: int = 1024, bucket_rows: int = 4096,
          block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every vector for which ``asked`` holds."""
    whole = stored(_whole(vectors, scale), "vectors")
    level = F.when(F.col("size") > 0, F.floor(F.log("size") / F.log(F.lit(STEP)))).otherwise(F.lit(-1)).cast("int")
    whole = whole.withColumn("class", level)
    classes = whole.groupBy("dim", "class").agg(F.count("*").alias("n"), F.max("size").alias("longest"))
    classes = stored(classes.withColumn("parts", F.ceil(F.col("n") / bucket_rows).cast("int")), "length-classes")
    rows = whole.join(classes.select("dim", "class", "parts"), ["dim", "class"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int"))
    rows = stored(rows.select("dim", "class", "part", "vec_id", "v"), "buckets")

    queries = whole.where(asked)
    blocks = max(1, -(-queries.count() // block_rows))
    queries = queries.select("dim", F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "size",
                             F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block"))
    queries = stored(queries.withColumn("ask", F.monotonically_increasing_id()), "query-vectors")

    def wanted(asking: DataFrame) -> DataFrame:
        """The buckets with a copy for each block of queries that asks for them."""
        keys = ["dim", "class", "part", "block"]
        blocks = asking.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct().toDF(*[f"_{c}" for c in keys])
        fits = (F.col("dim") == F.col("_dim")) & (F.col("class") == F.col("_class")) & (F.col("part") == F.col("_part"))
        return rows.join(blocks, fits).select(*keys[:3], F.col("_block").alias("block"), "vec_id", "v")

    top = classes.groupBy("dim").agg(F.max("class").alias("class"))
    first = queries.join(top, "dim").select("*", F.lit(0).alias("part"), F.lit(-(1 << 62)).cast("long").alias("floor"))
    start = _ranked(_met(first, wanted(first), k), k)
    start = stored(start.groupBy("ask").agg(
        F.when(F.count("*") == k, F.min("score")).alias("floor")), "floors")

    floor = F.coalesce("floor", F.lit(-(1 << 62)).cast("long"))
    asking = queries.join(start, "ask", "left").select("dim", "ask", "query_id", "q", "size", "block", floor.alias("floor"))
    reach = F.col("size") * F.col("longest") * (1 + _SLACK) + 1
    asking = asking.join(classes, "dim").where(F.col("floor") <= reach).select(
        "dim", "class", "block", "ask", "query_id", "q", "floor", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    asking = stored(asking, "asking")
    return _ranked(_met(asking, wanted(asking), k), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
