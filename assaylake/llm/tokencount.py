"""Token counts by byte-pair merging with a heap and a linked list, without producing identifiers.

The vocabulary is that of a SentencePiece byte-pair model with byte fallback. A text that is not empty gets the
model's leading blank, blanks become U+2581, and each character is a symbol; a character without a piece
counts as its UTF-8 bytes. The adjacent pair whose piece has the lowest rank, the leftmost among equals, is
merged until no adjacent pair is a piece: the count is the initial symbols minus the merges.

No piece holds a U+2581 behind another character, a line break, or a Latin letter beside a punctuation mark, so
merges never cross those places (checked when the model is read). Texts are cut there, and a
worker merges a stretch it remembers only once.

Null texts count as empty: no bytes, no tokens. Texts of any length are taken whole.
"""

from __future__ import annotations

import heapq
import re
import sys
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
MEMO_ENTRIES = 500_000  # stretches in each of two generations a worker remembers; only speed depends on it
MEMO_LENGTH = 48
LETTERS = "A-Za-zÀ-ÿ"
MARKS = ".,;:!?"


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of the pieces that merging can make, and the pattern of stretches that merge apart."""

    ranks: dict[str, float]
    pattern: str


def load_vocabulary(model_file: str) -> Vocabulary:
    """Read a SentencePiece model on the driver; its size is that of the vocabulary, whatever the corpus."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    if model.encode("  a") != model.encode(BLANK * 2 + "a") or model.encode("ª") == model.encode("a"):
        raise ValueError("only models that leave texts unnormalised are supported")
    ids = [i for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids}
    for piece in ranks:
        body = piece.lstrip(BLANK)
        if len(piece) > 1 and re.search(f"{BLANK}|[\n\t]|[{LETTERS}][{MARKS}]|[{MARKS}][{LETTERS}]", body):
            raise ValueError(f"piece {piece!r} crosses a place where texts are cut")
    end = f"{BLANK}\\n\\t"
    return Vocabulary(ranks, f"{BLANK}*[{LETTERS}]+(?=[{MARKS}{end}]|$)|{BLANK}*[{MARKS}]+(?=[{LETTERS}{end}]|$)|"
                             f"[\\n\\t]|{BLANK}*[^{end}]+|{BLANK}+")


def merged_count(stretch: str, ranks: dict[str, float]) -> int:
    """Tokens of one stretch."""
    n = len(stretch)
    symbols = list(stretch)
    count = sum([1 if c in ranks else len(c.encode("utf-8")) for c in symbols])
    if n < 2:
        return count
    following = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(symbols[i] + symbols[i + 1])
        if rank is not None:
            heap.append((rank, i, i + 1, 2))
    heapq.heapify(heap)
    while heap:
        _, left, right, size = heapq.heappop(heap)
        a, b = symbols[left], symbols[right]
        if not a or not b or len(a) + len(b) != size or following[left] != right:
            continue  # one of the two has been merged since
        symbols[left] = a + b
        symbols[right] = ""
        count -= 1
        after = following[left] = following[right]
        if after < n:
            before[after] = left
            rank = ranks.get(symbols[left] + symbols[after])
            if rank is not None:
                heapq.heappush(heap, (rank, left, after, len(symbols[left]) + len(symbols[after])))
        prior = before[left]
        if prior >= 0:
            rank = ranks.get(symbols[prior] + symbols[left])
            if rank is not None:
                heapq.heappush(heap, (rank, prior, left, len(symbols[prior]) + len(symbols[left])))
    return count


class Counter:
    """Counts texts, remembering short stretches."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks = vocabulary.ranks
        self.stretches = re.compile(vocabulary.pattern).findall
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        parts = self.stretches(BLANK + text.replace(" ", BLANK))
        counts = list(map(self.memo.get, parts))
        if None in counts:
            counts = [self._count(part) if count is None else count for part, count in zip(parts, counts)]
        return sum(counts)

    def _count(self, part: str) -> int:
        count = self.memo.get(part) or self.older.get(part) or merged_count(part, self.ranks)
        if len(part) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_ENTRIES:
                self.older, self.memo = self.memo, {}
            self.memo[part] = count
        return count


def _counter(vocabulary: Vocabulary) -> Counter:
    """This worker's counter, kept from task to task while the vocabulary stays the same."""
    held = getattr(re, "_assaylake_counter", None)
    if held is None or held.ranks != vocabulary.ranks:
        held = re._assaylake_counter = Counter(vocabulary)
    return held


def token_counts(docs: DataFrame, vocabulary: Vocabulary, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text)."""
    def run(batches):
        counter = _counter(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t.encode("utf-8")) for t in texts]
            counts = [counter(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
