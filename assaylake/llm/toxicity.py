"""Toxicity by a linear classifier over character n-grams scaled with naive Bayes log-count ratios.

* Features: which n-grams of bytes occur in a text (A-Z lower-cased, every blank alike), hashed into
  ``2 ** BITS`` buckets. Whole texts are read; counts within a text do not matter.
* Each feature is scaled by the log ratio of its smoothed share among toxic and clean training rows, and a
  logistic regression is fitted on the scaled features.
* Training rows: labelled, chosen by the caller's condition, at most ``rows`` of them (those with the smallest
  hash of ``doc_id``); the ``features`` n-grams that tell the classes apart best make up the model. Both bounds
  are parameters, so sample and model have a fixed size at any corpus size and may pass through the driver. It holds
  the features of the training rows as numbers of two bytes (four beyond 65,536 features) and unfolds some rows at a time.
* Null texts count as empty; an empty text gets the score of a text without any known feature. Without rows of
  both classes every score is the share of toxic rows (0 without rows). Unlabelled and null labels train nothing.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.anchors import Hasher, Powers
from assaylake.llm.shared import stored
from assaylake.llm.words import byte_symbols, chunks, text_bytes

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 20
GRAMS = (4, 5)
TRAINING_ROWS = 20_000
FEATURES = 30_000
FIT_PAIRS = 1 << 20  # (row, feature) pairs unfolded at a time while fitting
THRESHOLD = 0.7


@dataclass
class Model:
    buckets: np.ndarray  # of the features, ascending
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        """The feature's number for each bucket, or -1."""
        slots = np.full(1 << BITS, -1, np.int32)
        slots[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return slots


def _buckets(part: np.ndarray, own: np.ndarray, powers: Powers):
    """Bucket and document of every n-gram of a chunk."""
    blank = (part >= 0x09) & (part <= 0x0D)
    if blank.any():
        part = np.where(blank, np.uint8(0x20), part)
    hasher = Hasher(byte_symbols(part, lower=True), powers)
    for size in GRAMS:
        bucket = (hasher.grams(size) >> np.uint64(64 - BITS)).astype(np.int64)
        yield size, bucket


def _owners(at: np.ndarray, own: np.ndarray, size: int):
    """The document of each position, and whether an n-gram that starts there ends in it."""
    owner = np.searchsorted(own, at, "right") - 1
    return owner, at + size <= own[owner + 1]


def features_of(column, powers: Powers, slots: np.ndarray | None = None):
    """Distinct features of each document: (document, feature) pairs by chunk, and the range of rows."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        pairs = []
        for size, bucket in _buckets(data[offsets[first]:offsets[last]], own, powers):
            if slots is None:
                at = np.arange(len(bucket))
            else:
                bucket = slots[bucket]
                at = np.flatnonzero(bucket >= 0)
                bucket = bucket[at]
            owner, whole = _owners(at, own, size)
            pairs.append((owner[whole] << 32) | bucket[whole])
        pairs = np.unique(np.concatenate(pairs))
        yield pairs >> 32, pairs & 0xFFFFFFFF, first, last


def _class_counts(training: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): training rows of each class that have the feature."""
    def run(batches):
        powers = Powers()
        for batch in batches:
            label = np.asarray(batch.column(0)).astype(bool)
            counts = np.zeros((2, 1 << BITS), np.int64)
            for owner, bucket, first, _ in features_of(batch.column(1), powers):
                toxic = label[first + owner]
                counts[0] += np.bincount(bucket[toxic], minlength=1 << BITS)
                counts[1] += np.bincount(bucket[~toxic], minlength=1 << BITS)
            some = np.flatnonzero(counts.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])],
                                             ["bucket", "toxic", "clean"])

    return training.select("toxic", "text").mapInArrow(run, "bucket long, toxic long, clean long").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _narrow(features: int) -> type:
    return np.uint16 if features <= 1 << 16 else np.uint32


def _rows(training: DataFrame, slots: np.ndarray, kind: type) -> DataFrame:
    """(toxic, found): the features of each training row, as the bytes of numbers of type ``kind``."""
    def run(batches):
        powers = Powers()
        for batch in batches:
            for owner, found, first, last in features_of(batch.column(1), powers, slots):
                bound = np.searchsorted(owner, np.arange(last - first + 1))
                found = found.astype(kind)
                lists = [found[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(lists, pa.binary())], ["toxic", "found"])

    return training.select("toxic", "text").mapInArrow(run, "toxic int, found binary")


def _turns(bound: np.ndarray, pairs: int):
    """Ranges of rows with about ``pairs`` features each; a row stays whole."""
    first = 0
    while first < len(bound) - 1:
        last = max(first + 1, int(np.searchsorted(bound, bound[first] + pairs, "right")) - 1)
        yield first, last
        first = last


def _fit(toxic: np.ndarray, found: np.ndarray, bound: np.ndarray, ratios: np.ndarray, steps: int = 150,
         ridge: float = 1e-4, pairs: int = FIT_PAIRS):
    """Logistic regression on scaled features, by accelerated gradient steps; row ``i`` has ``found[bound[i]:bound[i + 1]]``."""
    n = len(toxic)
    turns = list(_turns(bound, pairs))
    counts = np.diff(bound)
    squares = sum(float(np.square(ratios[found[bound[a]:bound[b]]]).sum()) for a, b in turns) / n
    rate = 4.0 / (squares * 4 + 1.0)
    weights, bias = np.zeros(len(ratios)), float(np.log(toxic.mean() / (1 - toxic.mean())))
    ahead, ahead_bias = weights, bias
    for step in range(steps):
        scaled, pulls, total = ratios * ahead, np.zeros(len(ratios)), 0.0
        for a, b in turns:
            own = found[bound[a]:bound[b]]
            margin = np.full(b - a, ahead_bias)
            some = np.flatnonzero(counts[a:b])
            if len(some):
                margin[some] += np.add.reduceat(scaled[own], bound[a:b][some] - bound[a])
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[a:b]) / n
            pulls += np.bincount(own, np.repeat(error, counts[a:b]), len(ratios))
            total += float(error.sum())
        slope = ratios * pulls + ridge * ahead
        after, after_bias = ahead - rate * slope, ahead_bias - rate * total
        pull = step / (step + 3)
        ahead, ahead_bias = after + pull * (after - weights), after_bias + pull * (after_bias - bias)
        weights, bias = after, after_bias
    return weights * ratios, bias


def train(docs: DataFrame, labels: DataFrame, where: Column, *, rows: int = TRAINING_ROWS,
          features: int = FEATURES) -> Model:
    """Fit on at most ``rows`` labelled rows for which ``where`` (on ``doc_id``) holds."""
    chosen = (labels.where(where & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # the sample has at most `rows` rows of two numbers, whatever the size of the corpus
    training = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    training = stored(training.select("toxic", "text"), "training")
    seen = {r["toxic"]: r["n"] for r in training.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = 1.0 if 1 in seen else 0.0
        return Model(np.zeros(0, np.int64), np.zeros(0), 30.0 if share else -30.0)
    counts = _class_counts(training)
    total = counts.agg(F.sum(F.col("toxic") + 1).alias("toxic"), F.sum(F.col("clean") + 1).alias("clean")).first()
    ratio = F.log((F.col("toxic") + 1) / F.lit(float(total["toxic"]))) - F.log((F.col("clean") + 1) / F.lit(float(total["clean"])))
    # how far the toxic rows with the feature exceed or miss their expected number, in standard deviations
    rate = seen[1] / (seen[0] + seen[1])
    both = F.col("toxic") + F.col("clean")
    gap = F.abs(F.col("toxic") - both * rate) / F.sqrt(both * rate * (1 - rate) + 1)
    best = counts.select("bucket", ratio.alias("ratio"), gap.alias("gap")).orderBy(F.desc("gap"), "bucket").limit(features)
    best = best.toPandas().sort_values("bucket")
    buckets, ratios = best["bucket"].to_numpy(np.int64), best["ratio"].to_numpy()
    kind = _narrow(len(buckets))
    table = _rows(training, Model(buckets, ratios, 0.0).table(), kind).toArrow()
    lists = table.column("found").chunks
    found = np.concatenate([np.frombuffer(b"".join(x.to_pylist()), kind) for x in lists])
    bound = np.cumsum([0, *(len(v) // kind().itemsize for x in lists for v in x.to_pylist())])
    weights, bias = _fit(np.asarray(table.column("toxic")).astype(float), found, bound, ratios)
    return Model(buckets, weights, bias)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a last column ``name``: 0 to 1, higher where toxic is likelier."""
    names = docs.columns
    at = names.index("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        powers, slots = Powers(), model.table()
        for batch in batches:
            score = np.full(batch.num_rows, model.bias)
            for owner, found, first, last in features_of(batch.column(at), powers, slots):
                score[first:last] += np.bincount(owner, model.weights[found], last - first)
            score = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*names, name])

    return docs.mapInArrow(run, f"{kinds}, `{name}` double")


def third(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(third(doc_id) == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): trained on labels outside the fold that is held out."""
    model = train(docs, labels, third(F.col("doc_id")) != 1)
    return scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
