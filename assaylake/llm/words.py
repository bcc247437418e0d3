"""Texts of an Arrow batch as flat numpy arrays: bytes, words and their hashes.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. UTF-8 never uses those bytes inside a character, so words
are found on bytes, many documents at once and without a Python string for each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from assaylake.llm.anchors import Hasher, Powers

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 18  # texts are taken together up to this size, so that the arrays stay in the CPU's cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOLS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER_SYMBOLS = _SYMBOLS.copy()
_LOWER_SYMBOLS[0x41:0x5B] = _SYMBOLS[0x61:0x7B]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes; a longer document comes alone."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def slices(batches, rows: int = 256):
    """Smaller batches, for steps that make Python objects of every row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass
class Words:
    """Words of some documents: byte ranges, and the first and one past the last word of each document."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    n = len(data)
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, offsets[:-1]), np.searchsorted(start, offsets[1:]))


def byte_symbols(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """A fixed random 64-bit value for each byte; with ``lower``, A-Z count as a-z."""
    return (_LOWER_SYMBOLS if lower else _SYMBOLS)[data]


def word_hashes(data: np.ndarray, words: Words, powers: Powers, lower: bool = False) -> np.ndarray:
    return Hasher(byte_symbols(data, lower), powers).spans(words.start, words.end)
