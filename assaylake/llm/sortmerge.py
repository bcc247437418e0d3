"""Neighbours in the order of many byte strings, by a distributed merge sort that knows common prefixes.

1. Tasks sort runs of strings and front-code them: of each string only what differs from the one before is kept,
   with the length of their common prefix.
2. Runs are cut at splitters, and the front-coded pieces are exchanged so that each partition gets one range.
3. A partition merges its pieces with a loser tree whose entries carry the common prefix with the string that came
   out last. The longer one wins a match unread; only equal ones are compared, from there on.
4. What stands next to each other, within partitions and across their borders, is reported with its common prefix.

Splitters come from a sample of at most about ``SAMPLE`` strings, chosen by hash; it only balances the ranges.
Strings need not differ, but equal ones share a partition: give them a distinguishing tail to spread them.
"""

from __future__ import annotations

import bisect
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = 40_000
PARTITION = 40_000
SAMPLE = 20_000
MARK = b"\xff"


def common(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of two strings that agree on ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length of the rest, and the rests, of sorted strings."""
    shared = [0] * len(strings)
    for i in range(1, len(strings)):
        shared[i] = common(strings[i - 1], strings[i], 0)
    tails = [s[n:] for s, n in zip(strings, shared)]
    return np.array(shared, np.int32), np.array([len(t) for t in tails], np.int32), b"".join(tails)


def decoded(shared, sizes, tails: bytes):
    """The strings of a front-coded run, each with its common prefix with the one before."""
    at, last = 0, b""
    for n, size in zip(shared, sizes):
        last = last[:n] + tails[at:at + size]
        at += size
        yield last, n


def merged(runs):
    """Merge runs of (string, common prefix with the run's previous string); yields (string, prefix with last out, run)."""
    sources = [iter(r) for r in runs]
    width = 1
    while width < len(sources):
        width *= 2
    sources += [iter(())] * (width - len(sources))
    string: list[bytes | None] = [None] * width
    prefix = [0] * width
    for i, source in enumerate(sources):
        string[i] = next(source, (None, 0))[0]

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes that with the winner."""
        a, b = string[i], string[j]
        if b is None:
            return i, j
        if a is None:
            return j, i
        if prefix[i] > prefix[j]:
            return i, j
        if prefix[i] < prefix[j]:
            return j, i
        n = common(a, b, prefix[i])
        if a[n:n + 1] <= b[n:n + 1]:
            prefix[j] = n
            return i, j
        prefix[i] = n
        return j, i

    losers = [0] * width
    round_winners = list(range(width))
    level = width // 2
    while level:
        after = []
        for k in range(level):
            winner, losers[level + k] = play(round_winners[2 * k], round_winners[2 * k + 1])
            after.append(winner)
        round_winners, level = after, level // 2
    champion = round_winners[0]
    while string[champion] is not None:
        yield string[champion], prefix[champion], champion
        string[champion], prefix[champion] = next(sources[champion], (None, 0))
        node = (champion + width) // 2
        while node:
            champion, losers[node] = play(champion, losers[node])
            node //= 2


_PIECE = "part int, shared binary, sizes binary, tails binary, ids binary"


def _pieces(items: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Sorted, front-coded runs, cut at the splitters."""
    def run(batches):
        held: list[tuple[bytes, int]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, RUN):
                part = batch.slice(at, RUN)
                held += zip(part.column(1).to_pylist(), part.column(0).to_pylist())
                if len(held) >= RUN:
                    yield cut(held)
                    held = []
        if held:
            yield cut(held)

    def cut(held):
        held.sort()
        strings = [s for s, _ in held]
        ids = np.array([i for _, i in held], np.int64)
        bounds = [0, *[bisect.bisect_left(strings, s) for s in splitters], len(strings)]
        out = [[] for _ in range(5)]
        for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                shared, sizes, tails = front_coded(strings[a:b])
                for column, value in zip(out, (part, shared.tobytes(), sizes.tobytes(), tails, ids[a:b].tobytes())):
                    column.append(value)
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["part", "shared", "sizes", "tails", "ids"])

    return items.select("id", "string").mapInArrow(run, _PIECE)


def related(a: bytes, b: bytes, shared: int, skip: int) -> tuple[int, int]:
    """How much two strings share before their marks, and how much behind them."""
    i, j = a.find(MARK, skip), b.find(MARK, skip)
    if i < 0 or j < 0:
        return shared, 0
    if shared > i:
        return i, shared - i - 1
    return shared, common(a[i + 1:], b[j + 1:], 0)


def adjacent(items: DataFrame, skip: int = 0) -> DataFrame:
    """(a, b, shared, beyond) for all neighbours in the order of ``items`` (id, string).

    A string may hold a mark (byte 0xFF, which UTF-8 never uses) from ``skip`` on: ``shared`` is the common prefix up to
    the mark, ``beyond`` that of what follows it in either string.
    """
    total = items.count()
    parts = max(1, -(-total // PARTITION))
    splitters: list[bytes] = []
    if parts > 1:
        every = max(1, total // SAMPLE)
        sample = items.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("string").toArrow().column(0).to_pylist()
        sample.sort()
        splitters = sorted({sample[len(sample) * k // parts] for k in range(1, parts)}) if sample else []

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["part", "a", "b", "shared", "beyond", "edge"]

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("shared", "sizes", "tails", "ids"))))
        ids = [iter(np.frombuffer(r[3], np.int64).tolist()) for r in rows]
        runs = [decoded(np.frombuffer(r[0], np.int32).tolist(), np.frombuffer(r[1], np.int32).tolist(), r[2]) for r in rows]
        out = [[] for _ in names]
        last, before = None, None
        for string, shared, run in merged(runs):
            here = next(ids[run])
            row = (part, None, here, None, None, string) if last is None else (
                part, before, here, *related(last, string, shared, skip), None)
            for column, value in zip(out, row):
                column.append(value)
            last, before = string, here
        for column, value in zip(out, (part, before, None, None, None, last)):
            column.append(value)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    found = stored(_pieces(items, splitters).groupBy("part").applyInArrow(
        merge, "part int, a long, b long, shared int, beyond int, edge binary"), "neighbours")
    # the first and last string of each partition meet across the border; a row or two for each splitter
    order = Window.orderBy("part")
    border = (found.where("b is null").select("part", "a", F.col("edge").alias("left"))
              .join(found.where("a is null").select("part", "b", F.col("edge").alias("right")), "part")
              .select(F.lag("a").over(order).alias("a"), "b", F.lag("left").over(order).alias("left"), "right").where("a is not null"))

    def compare(batches):
        for batch in batches:
            rows = [related(x, y, common(x, y, 0), skip) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())],
                ["a", "b", "shared", "beyond"])

    border = border.mapInArrow(compare, "a long, b long, shared int, beyond int")
    return found.where("a is not null and b is not null").select("a", "b", "shared", "beyond").unionAll(border)
