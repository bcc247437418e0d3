"""Anchors chosen by content: equal windows of symbols always choose equal anchors.

Every window of ``window`` consecutive symbols (bytes or words) picks the ``gram``-symbol stretch inside it
with the smallest hash, the leftmost on ties. The choice depends on the window's content alone, so two equal
windows pick anchors with equal hashes at equal distances: windows whose anchors differ cannot be equal, and
windows that share a hash are compared exactly later. Neighbouring windows mostly pick the same anchor, so
there is about one anchor for every ``(window - gram) / 2`` symbols.

Everything here is numpy over one batch of documents.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and of its inverse, kept between batches."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return self.up[:n], self.down[:n]


class Hasher:
    """Hashes of any stretch of one batch of symbols, from running sums."""

    def __init__(self, symbols: np.ndarray, powers: Powers):
        n = len(symbols)
        up, self.down = powers.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * up[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive keys, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys = np.minimum(keys[:-step], keys[step:])
        have += step
    return keys


def segments(hasher: Hasher, starts: np.ndarray, ends: np.ndarray, window: int, gram: int):
    """Runs of windows that share an anchor.

    ``starts`` and ``ends`` bound the documents of the batch. Returns arrays, one item per run: the document's
    number in the batch, the first and last window start, the place of the anchor and its hash.
    """
    room = np.maximum(ends - starts - window + 1, 0)
    total = int(room.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(starts)), room)
    at = np.arange(total) - np.repeat(np.cumsum(room) - room, room) + np.repeat(starts, room)
    hashes = hasher.grams(gram)
    low = np.uint64((1 << int(len(hashes)).bit_length()) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_smallest(keys, window - gram + 1)[at] & low).astype(np.int64)
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    return owner[first], at[first], at[last], anchor[first], hashes[anchor[first]]


def equal_runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last item of each run of items that agree in all columns."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    begin = np.flatnonzero(new)
    return begin, np.append(begin, n)[1:] - 1
