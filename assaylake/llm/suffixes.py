"""Substring dedup over bytes: sorted suffixes merged by what they are known to share.

A byte goes if a ``window``-byte string that covers it also starts anywhere else, in the same document or another.

1. The windows of a document fall into segments with one anchor each, chosen by content; equal windows lie in segments
   with equal anchors at equal distances. Anchors that occur once are dropped. Equal segments count as one variant; a variant
   that occurs twice is removed whole.
2. For anchors with several variants the suffixes that start at the anchor are sorted, and so are the texts read
   leftwards from it: front-coded runs, exchanged by range and merged (see ``sortmerge``). Neighbours in either order
   show how far a variant is repeated to the right (most), to the left (most), and exactly how far with that neighbour.
3. Windows inside what a variant shares with a neighbour are repeated; windows that reach beyond what it
   shares with anybody are not. The few in between are sorted as suffixes themselves, along with the windows of the same
   anchor and distance they could equal: neighbours that share the whole window are repeated.

All comparisons behind a hash of equal segments are on bytes. Null texts count as empty. Null ids take part like any
document; rows that agree in id and text count as occurrences of each other and get equal results.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.anchors import Hasher, Powers, equal_runs, segments
from assaylake.llm.shared import stored
from assaylake.llm.sortmerge import MARK, adjacent
from assaylake.llm.words import byte_symbols, chunks, slices, text_bytes

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 200
GRAM = 40


def _segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, content, doc, digest, lo, n, off, times, last): windows by anchor.

    ``off`` is the anchor's distance from ``lo``. Equal segments that follow each other, as in a repeated line, are
    one row: ``times`` of them, the last one at ``last``.
    """
    def run(batches):
        powers = Powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last in chunks(offsets):
                own = offsets[first:last + 1] - offsets[first]
                hasher = Hasher(byte_symbols(data[offsets[first]:offsets[last]]), powers)
                row, lo, hi, at, anchor = segments(hasher, own[:-1], own[1:], window, gram)
                content = hasher.spans(lo, hi + window)
                begin, end = equal_runs(row, content, anchor)
                base = own[row[begin]]
                places = (lo[begin] - base, (hi - lo + window)[begin], (at - lo)[begin], end - begin + 1, lo[end] - base)
                document = pa.array(first + row[begin])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[begin].view(np.int64)), pa.array(content[begin].view(np.int64)), batch.column(0).take(document),
                     batch.column(1).take(document), *[pa.array(p.astype(np.int32)) for p in places]],
                    ["anchor", "content", "doc", "digest", "lo", "n", "off", "times", "last"])

    return docs.select("doc", "digest", "text").mapInArrow(
        run, "anchor long, content long, doc long, digest long, lo int, n int, off int, times int, last int")


def _cut(needed: DataFrame) -> DataFrame:
    """(id, anchor, content, n, off, whole, bytes): the variants that must be compared."""
    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        names = ["id", "anchor", "content", "n", "off", "whole", "bytes"]
        for batch in slices(batches):
            out = [[] for _ in names]
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode("utf-8")
                for w in wanted:
                    row = (w["id"], w["anchor"], w["content"], w["n"], w["off"], w["whole"], data[w["lo"]:w["lo"] + w["n"]])
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    return needed.select("text", "wanted").mapInArrow(
        run, "id long, anchor long, content long, n int, off int, whole boolean, bytes binary")


def _strings(cut: DataFrame, leftwards: bool) -> DataFrame:
    """(id, string): to the right from the anchor, mark, leftwards from it - or the other way round behind the anchor's hash."""
    def run(batches):
        for batch in slices(batches, 2000):
            strings = []
            for anchor, off, data in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                right, left = data[off:], data[:off][::-1]
                strings.append(anchor.to_bytes(8, "big", signed=True) + left + MARK + right if leftwards else right + MARK + left)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(strings, pa.binary())], ["id", "string"])

    return cut.select("id", "anchor", "off", "bytes").mapInArrow(run, "id long, string binary")


def _shares(cut: DataFrame) -> DataFrame:
    """(id, right, left): what a variant shares with a neighbour of its anchor, on both sides of it."""
    ahead = adjacent(_strings(cut, False)).select("a", "b", F.col("shared").alias("right"), F.col("beyond").alias("left"))
    behind = adjacent(_strings(cut, True), skip=8).where("shared >= 8").select(
        "a", "b", F.col("beyond").alias("right"), (F.col("shared") - 8).alias("left"))
    both = ahead.unionAll(behind)
    return both.select(F.col("a").alias("id"), "right", "left").unionAll(both.select(F.col("b").alias("id"), "right", "left"))


def _settled(variants: DataFrame, window: int) -> DataFrame:
    """(id, anchor, content, low, high, sure, open): by distance of the anchor from the window's start.

    ``low`` to ``high`` can be repeated, ``sure`` ranges are, ``open`` are those in between.
    """
    pair = pa.struct([("low", pa.int32()), ("high", pa.int32())])

    def run(batches):
        names = ["id", "anchor", "content", "low", "high", "sure", "open"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pair), pa.list_(pair))
        for batch in slices(batches, 2000):
            out = [[] for _ in names]
            for id_, anchor, content, n, off, whole, shares in zip(*(c.to_pylist() for c in batch.columns)):
                least, most = off - (n - window), off
                if whole:
                    row = (id_, anchor, content, least, most, [(least, most)], [])
                else:
                    low = max(least, window - max(s["right"] for s in shares))
                    high = min(most, max(s["left"] for s in shares))
                    sure = sorted((max(low, window - s["right"]), min(high, s["left"])) for s in shares)
                    joined, gaps, at = [], [], low
                    for a, b in sure:
                        if a > b:
                            continue
                        if a > at:
                            gaps.append((at, a - 1))
                        if joined and a <= joined[-1][1] + 1:
                            joined[-1] = (joined[-1][0], max(joined[-1][1], b))
                        else:
                            joined.append((a, b))
                        at = max(at, b + 1)
                    if at <= high:
                        gaps.append((at, high))
                    row = (id_, anchor, content, low, high, joined, gaps)
                for column, value in zip(out, row):
                    column.append(value)
            columns = [pa.array(c if i < 5 else [[{"low": a, "high": b} for a, b in x] for x in c], t)
                       for i, (c, t) in enumerate(zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return variants.select("id", "anchor", "content", "n", "off", "whole", "shares").mapInArrow(
        run, "id long, anchor long, content long, low int, high int, sure array<struct<low:int,high:int>>, open array<struct<low:int,high:int>>")


def _open_windows(cut: DataFrame, window: int) -> DataFrame:
    """(id, string) of single windows; the id holds variant and distance, and ends the string."""
    def run(batches):
        for batch in slices(batches, 2000):
            ids, strings = [], []
            for id_, off, data, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                for o in range(low, high + 1):
                    number = id_ << 9 | o
                    ids.append(number)
                    strings.append(data[off - o:off - o + window] + MARK + number.to_bytes(8, "big", signed=True))
                if len(ids) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(strings, pa.binary())], ["id", "string"])
                    ids, strings = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(strings, pa.binary())], ["id", "string"])

    return cut.select("id", "off", "bytes", "from", "to").mapInArrow(run, "id long, string binary")


def repeated_spans(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, digest, spans): byte ranges that go, as (first, last) offsets.

    ``docs`` has text, and doc and digest to tell texts apart.
    """
    if window > 500:
        raise ValueError("windows of more than 500 bytes need wider window numbers")
    known = stored(_segments(docs, window, gram), "segments")
    # written, so that a frequent anchor's rows can be split when they are joined
    several = stored(known.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"), "recurring-anchors")
    known = stored(known.join(several, "anchor", "left_semi"), "recurring-segments")
    variants = known.groupBy("anchor", "content").agg(
        F.sum("times").alias("count"), F.min(F.struct("doc", "digest", "lo", "n", "off")).alias("first"))
    variants = stored(variants.withColumn("id", F.monotonically_increasing_id()), "variants")
    per_anchor = variants.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1").select("anchor")
    wanted = variants.join(per_anchor, "anchor", "left_semi").select(
        F.col("first.doc").alias("doc"), F.col("first.digest").alias("digest"), F.struct(
            "id", "anchor", "content", (F.col("count") > 1).alias("whole"), F.col("first.lo").alias("lo"),
            F.col("first.n").alias("n"), F.col("first.off").alias("off")).alias("w"))
    wanted = wanted.groupBy("doc", "digest").agg(F.collect_list("w").alias("wanted"))
    # a repeated row comes twice, which changes nothing: its variants occur twice and are removed whole
    cut = stored(_cut(docs.join(wanted, ["doc", "digest"])), "compared")

    shares = _shares(cut).groupBy("id").agg(F.collect_list(F.struct("right", "left")).alias("shares"))
    settled = stored(_settled(cut.drop("bytes").join(shares, "id"), window), "settled")
    left_open = settled.select("anchor", F.explode("open").alias("o")).groupBy("anchor").agg(
        F.min("o.low").alias("lowest"), F.max("o.high").alias("highest"))
    asked = settled.join(left_open, "anchor").select(
        "id", F.greatest("low", "lowest").alias("from"), F.least("high", "highest").alias("to")).where("from <= to")
    windows = stored(_open_windows(cut.join(asked, "id"), window), "open-windows")
    equal = adjacent(windows).where(F.col("shared") == window)
    equal = equal.select(F.explode(F.array("a", "b")).alias("number")).distinct().select(
        F.shiftright("number", 9).alias("id"), F.col("number").bitwiseAND(F.lit(511)).cast("int").alias("o"))
    sure = settled.select("id", F.explode("sure").alias("s")).select("id", F.col("s.low").alias("low"), F.col("s.high").alias("high"))
    sure = sure.unionAll(equal.select("id", F.col("o").alias("low"), F.col("o").alias("high")))
    # as offsets in the segment
    found = sure.join(variants.select("id", "anchor", "content", F.col("first.off").alias("at")), "id").select(
        "anchor", "content", (F.col("at") - F.col("high")).alias("begin"), (F.col("at") - F.col("low") + window).alias("end"))
    alone = variants.where("count > 1").join(per_anchor, "anchor", "left_anti").select(
        "anchor", "content", F.lit(0).alias("begin"), F.col("first.n").alias("end"))
    found = stored(found.unionAll(alone).groupBy("anchor", "content").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges")), "repeated-variants")
    spans = known.join(found, ["anchor", "content"]).select("doc", "digest", "lo", "last", F.explode("ranges").alias("r"))
    return spans.groupBy("doc", "digest").agg(F.collect_set(F.struct(
        (F.col("lo") + F.col("r.begin")).alias("first"), (F.col("last") + F.col("r.end")).alias("last"))).alias("spans"))


def kept_bytes(data: bytes, spans) -> tuple[bytes, int, int]:
    """What stays, how many bytes go, and in how many runs."""
    parts, at, gone, runs, reach = [], 0, 0, 0, -1
    for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
        if first > reach:
            runs += 1
            parts.append(data[at:first])
            gone += last - first
            at = reach = last
        elif last > reach:
            gone += last - reach
            at = reach = last
    parts.append(data[at:])
    return b"".join(parts), gone, runs


def repeat_counts(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("digest", F.xxhash64("text"))
    spans = stored(repeated_spans(rows, window=window, gram=gram), "spans")

    def run(batches):
        for batch in slices(batches):
            out = [[] for _ in range(4)]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8")
                kept, gone, runs = kept_bytes(data, spans)
                for column, value in zip(out, (len(data), gone, runs, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.join(spans, ["doc", "digest"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
