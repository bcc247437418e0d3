"""Benchmark decontamination: word n-grams as seeds, then Smith-Waterman alignment.

* Words are runs outside ``\\x20\\x09-\\x0D``, A-Z lower-cased. Every n-gram of an item is a seed; items of up to
  ten words have pairs and of up to five single words instead.
* Around each seed in a document lies a stretch that holds any alignment through it which reaches ``least``: the gaps
  such an alignment can afford bound it. A stretch that shares too few words with the item cannot reach ``least`` and is
  left out; overlapping ones are joined and aligned with the item (match 2, other word -1, gap -1). The similarity is
  the score over that of a perfect copy.
* A pair of document and item comes back if the similarity reaches ``least``: an exact copy has 1.0. At 0.6
  every accepted copy of up to ten words holds a seed, and so does a longer one edited by substitutions alone; a longer
  one with gaps is missed where it keeps no n-gram whole.

Items are taken in slices of at most ``slice_grams`` n-grams: what travels to the tasks has that bound, and a larger
benchmark takes more passes over the documents. Documents are read whole and never shuffled. Null and empty texts match
nothing; equal rows give equal results, once each; items with equal texts are both reported.
"""

from __future__ import annotations

import sys
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.anchors import Hasher, Powers
from assaylake.llm.words import chunks, text_bytes, word_hashes, words_of

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 3
LEAST = 0.6
SLICE_GRAMS = 1 << 20
_FILTER_BITS = 22


class Lookup:
    """Which of many hashes occur in a fixed set, by a bit table first."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known)
        self.table = np.zeros(1 << _FILTER_BITS, bool)
        self.table[(self.known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that hold a known hash, and its number."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(self.known):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        same = self.known[number] == hashes[at]
        return at[same], number[same]


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of each item."""
    powers, out = Powers(), []
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    for first, last in chunks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        words = words_of(part, own)
        hashes = word_hashes(part, words, powers, lower=True)
        out += [hashes[a:b] for a, b in zip(words.first, words.last)]
    return out


def seed_size(count: int, gram: int) -> int:
    """Words of a seed of an item of ``count`` words: few enough that substitutions up to the least similarity leave one whole."""
    return min(gram, 1 if count <= 5 else 2 if count <= 10 else gram)


def _grams(words: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    return Hasher(words, powers).grams(seed_size(len(words), size)) if len(words) else np.zeros(0, np.uint64)


def _document_grams(column, sizes: list[int], powers: Powers):
    """By document: its word hashes, and for each size positions and hashes of its n-grams, chunk by chunk."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        words = words_of(part, own)
        hashes = word_hashes(part, words, powers, lower=True)
        hasher = Hasher(hashes, powers)
        yield first, words, hashes, [(size, hasher.grams(size)) for size in sizes]


def _inside(at: np.ndarray, size: int, words) -> tuple[np.ndarray, np.ndarray]:
    """The document of each n-gram position, and whether the n-gram ends in it."""
    owner = np.searchsorted(words.last, at, "right")
    return owner, at + size <= words.last[np.minimum(owner, len(words.last) - 1)]


def aligned(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the first and one past the last word of the passage in it."""
    step = np.arange(len(item) + 1)
    above = np.zeros(len(item) + 1, np.int64)
    begun = np.zeros(len(item) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(passage):
        straight = np.zeros(len(item) + 1, np.int64)
        straight[1:] = above[:-1] + np.where(item == word, 2, -1)
        start = np.full(len(item) + 1, i)
        start[1:] = np.where(above[:-1] > 0, begun[:-1], i)
        down = above - 1
        better = down > straight
        start = np.where(better, begun, start)
        score = np.maximum(np.maximum(straight, down), 0)
        # gaps in the passage run along the row: the best earlier cell less its distance
        run = np.maximum.accumulate(((score + step) << 20) | (len(item) - step))
        across, origin = (run >> 20) - step, len(item) - (run & 0xFFFFF)
        longer = across > score
        begun = np.where(longer, start[origin], start)
        above = np.where(longer, across, score)
        top = int(above.max())
        if top > best[0]:
            best = (top, int(begun[int(above.argmax())]), i + 1)
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, *, gram: int = GRAM, least: float = LEAST,
                 slice_grams: int = SLICE_GRAMS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, last_word): documents with a copy of an item, and where it is."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, similarity double, first_word long, last_word long"
    found = spark.createDataFrame([], schema)
    held, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    for row in items.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= slice_grams:
            found = found.unionAll(_slice(docs, held, gram, least, schema))
            held, size = [], 0
    return found.unionAll(_slice(docs, held, gram, least, schema)) if held else found


def _slice(docs: DataFrame, items: list[tuple[int, str]], gram: int, least: float, schema: str) -> DataFrame:
    powers = Powers()
    words = item_words([text for _, text in items])
    grams = [_grams(w, gram, powers) for w in words]
    sizes = sorted({seed_size(len(w), gram) for w in words if len(w)})
    if not sizes:
        return docs.sparkSession.createDataFrame([], schema)
    seeds: dict[int, list[tuple[int, int]]] = {}
    for k, own in enumerate(grams):
        for at, gram_hash in enumerate(own.tolist()):
            seeds.setdefault(gram_hash, []).append((k, at))
    return docs.mapInArrow(_finder(items, words, seeds, gram, least), schema)


def _finder(items, words, seeds, gram, least):
    lookup = Lookup(np.array(sorted(seeds), np.uint64))
    places = [seeds[int(h)] for h in lookup.known]
    taken = [seed_size(len(w), gram) for w in words]
    sizes = sorted({size for size, w in zip(taken, words) if len(w)})

    def run(batches):
        powers = Powers()
        for batch in batches:
            out = []
            for first, own, hashes, grams in _document_grams(batch.column(1), sizes, powers):
                hits = []
                for size, gram_hashes in grams:
                    at, number = lookup(gram_hashes)
                    owner, whole = _inside(at, size, own)
                    hits += [(int(o), k, int(a) - p) for o, a, n in zip(owner[whole], at[whole], number[whole])
                             for k, p in places[n] if taken[k] == size]
                for row, item, score, begin, end in _groups(sorted(set(hits)), own, hashes, words, least):
                    out.append((batch.column(0)[first + row].as_py(), items[item][0], score, begin, end))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             ["doc_id", "item_id", "similarity", "first_word", "last_word"])

    return run


def _shared(stretch: np.ndarray, known: np.ndarray, counts: np.ndarray) -> int:
    """How many words of an item (distinct ones, and how often it has each) a stretch can match at most."""
    at = np.minimum(np.searchsorted(known, stretch), len(known) - 1)
    return int(np.minimum(np.bincount(at[known[at] == stretch], minlength=len(known)), counts).sum())


def _groups(hits, own, hashes, words, least):
    """Alignments of the stretches around seeds (row, item, diagonal), in order; the best one of each document and item."""
    best: dict[tuple[int, int], tuple] = {}
    for (row, item), diagonals in groupby(hits, key=lambda h: h[:2]):
        size = len(words[item])
        known, counts = np.unique(words[item], return_counts=True)
        enough = least * size - 1e-9
        # gaps cost one each, and a perfect copy has no more than this to lose
        slack = int(2 * size * (1 - least)) + 1
        stretches: list[list[int]] = []
        for _, _, diagonal in diagonals:
            low, high = max(int(own.first[row]), diagonal - slack), min(int(own.last[row]), diagonal + size + slack)
            if _shared(hashes[low:high], known, counts) < enough:
                continue
            if stretches and low <= stretches[-1][1]:
                stretches[-1][1] = high
            else:
                stretches.append([low, high])
        for low, high in stretches:
            score, a, b = aligned(hashes[low:high], words[item])
            similarity = score / (2 * size)
            if similarity >= least and similarity > best.get((row, item), (0.0,))[0]:
                best[row, item] = (similarity, low + a - int(own.first[row]), low + b - int(own.first[row]))
    for (row, item), (similarity, a, b) in best.items():
        yield row, item, similarity, a, b
