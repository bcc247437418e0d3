"""Alignment of two tokenizers by products of token-byte incidence matrices in hand-built CSR.

Byte tokens A encode a blank and the text, piece tokens B the text (their model adds the blank); both then cover the same
bytes. For a batch of texts:

1. ``A`` has a row for each A token with a one at each of its bytes, ``B`` likewise. Gustavson's row products ``A . B^T`` give the
   overlap links: pairs of tokens that share bytes, with the number of bytes they share.
2. Overlapping tokens whose byte ranges end together are end links; where they end, the text is cut into groups.
3. The token-group incidences ``G_A`` and ``G_B`` give the shared-group links: row i of ``G_A . G_B^T`` is one row of ``G_B^T``, so the
   product is held as row pointers into it and no pair is written out.

A text is cut before a blank between a character that is no blank and a letter or number. No token of either vocabulary crosses
such a place (of B this is checked when the model is read), so stretches are encoded apart and a worker encodes and aligns a
stretch it remembers once; the matrices of a text are the rows of its stretches, put together. Texts of any length are taken whole.

Counts of linked id pairs cover the whole corpus. The texts are read twice, so that no tokens are stored: once to count, with links
summed by stretch and then by pair within a task before they travel, and once to look counts up. The ``frequent`` pairs with the
highest counts, a bounded number, go to all tasks and settle most links there; the others are joined by pair.

Null and empty texts and those whose bytes the tokens do not give back have no tokens. Repeated rows are counted and returned
each on their own; rows without ``doc_id`` are kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
CUT = re.compile(r"(?<=\S) (?=[^\W_])")
OPENS = re.compile(r"[^\W_]").match
MEMO_STRETCHES = 300_000  # stretches a worker remembers; only speed depends on it
JOINED = 1000  # new stretches that are encoded as one text
FREQUENT = 20_000  # id pairs that are sent to all tasks
BATCH_BYTES = 1 << 18  # texts that are put together at a time, about


@dataclass
class Csr:
    """A sparse matrix of ones: row i has the columns ``indices[indptr[i]:indptr[i + 1]]``, ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    width: int

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.width), out=indptr[1:])
        return Csr(indptr, rows[order], len(self.indptr) - 1)


def incidence(sizes: np.ndarray) -> Csr:
    """Rows for things of the given sizes that follow each other; the columns are their units."""
    indptr = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=indptr[1:])
    return Csr(indptr, np.arange(indptr[-1]), int(indptr[-1]))


def take_rows(matrix: Csr, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of some rows one after another, and how many each has."""
    sizes = matrix.indptr[rows + 1] - matrix.indptr[rows]
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(first - matrix.indptr[rows], sizes)
    return matrix.indices[at], sizes


def row_products(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product of two matrices by Gustavson's method: (row, column, value) of its entries, rows ascending.

    Each row of ``a`` adds up the rows of ``b`` that its columns name.
    """
    columns, sizes = take_rows(b, a.indices)
    rows = np.repeat(np.repeat(np.arange(len(a.indptr) - 1), np.diff(a.indptr)), sizes)
    keys = rows * np.int64(max(b.width, 1)) + columns
    if np.any(keys[1:] < keys[:-1]):
        keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return keys[first] // max(b.width, 1), keys[first] % max(b.width, 1), np.diff(np.append(first, len(keys)))


@dataclass
class Alignment:
    """Links of a run of tokens; ``overlap`` has (A token, B token, bytes), ``ends`` the numbers of those that end together.

    Group g has the A tokens ``groups_a[g]:groups_a[g + 1]`` and the B tokens ``groups_b[g]:groups_b[g + 1]``. Row i of the shared-group
    links has the B tokens ``groups_b[shared[i]]:groups_b[shared[i] + 1]``.
    """

    overlap: tuple[np.ndarray, np.ndarray, np.ndarray]
    ends: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray
    shared: np.ndarray


def aligned(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Alignment:
    """Links between tokens with these byte sizes; both must cover the same bytes."""
    a, b = incidence(sizes_a), incidence(sizes_b)
    left, right, shared = row_products(a, b.transposed())
    ends = np.flatnonzero(a.indptr[left + 1] == b.indptr[right + 1])
    cut_a = np.concatenate([[0], left[ends] + 1]).astype(np.int64)
    cut_b = np.concatenate([[0], right[ends] + 1]).astype(np.int64)
    member = np.repeat(np.arange(len(ends)), np.diff(cut_a))  # the one column of each row of G_A
    return Alignment((left, right, shared), ends, cut_a, cut_b, member)


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """The two models, as what their files hold; their size is that of the vocabularies, whatever the corpus.

    As a broadcast value it stays with a worker from task to task, and with it the encoder opened there.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, piece_model: bytes):
        self.ranks, self.pattern, self.piece_model, self.encoder = ranks, pattern, piece_model, None

    def __getstate__(self):
        return self.__dict__ | {"encoder": None}

    def opened(self) -> Encoder:
        if self.encoder is None:
            self.encoder = Encoder(self)
        return self.encoder


# fixed values: the pattern by which byte-level vocabularies of this kind part texts
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_vocabularies(byte_file: str, piece_file: str) -> Vocabularies:
    """Read both models on the driver.

    Checks that ids of A are ranks, so that it can be encoded by them, and that no piece of B crosses a place where texts are cut.
    """
    import sentencepiece

    with open(byte_file, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
    made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    parts = file.get("pre_tokenizer") or {}
    if file.get("normalizer") or parts.get("type") != "ByteLevel" or parts.get("add_prefix_space") or not parts.get("use_regex") or any(
            vocabulary[piece] != 256 + i for i, piece in enumerate(made)):
        raise ValueError("only byte-level vocabularies whose ids are the ranks of their merges are supported")
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items()}
    with open(piece_file, "rb") as f:
        piece_model = f.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
    for i in range(len(model)):
        if BLANK in model.id_to_piece(i).lstrip(BLANK):
            raise ValueError(f"piece {model.id_to_piece(i)!r} crosses a place where texts are cut")
    return Vocabularies(ranks, PATTERN, piece_model)


def _byte_rows(pieces: list[bytes]) -> Csr:
    """The bytes of every id of a vocabulary."""
    indptr = np.cumsum([0, *map(len, pieces)])
    return Csr(indptr, np.frombuffer(b"".join(pieces), np.uint8), 256)


def _together(found):
    """Ids, counts and validity of several runs of stretches as one."""
    ids, counts = ([np.concatenate([f[k][side] for f in found]) for side in (0, 1)] for k in (0, 1))
    return ids, counts, [ok for f in found for ok in f[2]]


class Rows:
    """CSR rows that more are added to."""

    def __init__(self, kind: type):
        self.indptr, self.values, self.used, self.count = np.zeros(1024, np.int64), np.zeros(4096, kind), 0, 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        n, size = len(sizes), len(values)
        if self.count + n + 1 > len(self.indptr):
            self.indptr = np.resize(self.indptr, 2 * (self.count + n + 1))
        if self.used + size > len(self.values):
            self.values = np.resize(self.values, 2 * (self.used + size))
        self.indptr[self.count + 1:self.count + n + 1] = self.used + np.cumsum(sizes)
        self.values[self.used:self.used + size] = values
        self.count += n
        self.used += size

    def matrix(self) -> Csr:
        return Csr(self.indptr[:self.count + 1], self.values[:self.used], 0)


class Encoder:
    """Encodes stretches of text with both models and remembers their tokens and links, as rows of CSR matrices."""

    def __init__(self, vocabularies: Vocabularies):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=vocabularies.pattern, mergeable_ranks=vocabularies.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.piece_model)
        pieces_a: list[bytes] = [b""] * (max(vocabularies.ranks.values()) + 1)
        for piece, i in vocabularies.ranks.items():
            pieces_a[i] = piece
        pieces_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else
                    self.b.id_to_piece(i).replace(BLANK, " ").encode("utf-8") for i in range(len(self.b))]
        self.bytes_a, self.bytes_b = _byte_rows(pieces_a), _byte_rows(pieces_b)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.invalid: set[int] = set()
        self.groups_text: list[str] = []
        self.ids_a, self.ids_b, self.group_a, self.group_b, self.shared = (Rows(np.int32) for _ in range(5))
        self.pairs = Rows(np.int64)  # ids that end together, packed as ``a << 32 | b``

    def full(self) -> bool:
        return len(self.numbers) > MEMO_STRETCHES

    def _encode(self, stretches: list[str]):
        """Ids of A and of B tokens and how many each stretch has; where the tokens give other bytes back, none.

        Stretches that begin and end like the places where texts are cut are put together and encoded as one text.
        """
        joined = " ".join(stretches)
        whole = np.frombuffer((" " + joined).encode("utf-8"), np.uint8)
        ids = [np.array(self.a.encode_ordinary(" " + joined), np.int32), np.array(self.b.encode(joined), np.int32)]
        given = [take_rows(table, own) for table, own in zip((self.bytes_a, self.bytes_b), ids)]
        if not all(np.array_equal(data, whole) for data, _ in given):
            if len(stretches) == 1:
                return [i[:0] for i in ids], [np.zeros(1, np.int64)] * 2, [False]
            return _together([self._encode([s]) for s in stretches])
        bound = np.cumsum([len(s.encode("utf-8")) + 1 for s in stretches])
        counts = [np.diff(np.searchsorted(np.cumsum(sizes), bound, "right"), prepend=0) for _, sizes in given]
        return ids, counts, [True] * len(stretches)

    def _learn(self, stretches: list[str]) -> None:
        """Encode new stretches and align their tokens, all of them in one product."""
        plain = [s for s in stretches if OPENS(s) and not s[-1].isspace() and BLANK not in s]
        known = set(plain)
        runs = [[s] for s in stretches if s not in known] + [plain[at:at + JOINED] for at in range(0, len(plain), JOINED)]
        (flat_a, flat_b), (n_a, n_b), valid = _together([self._encode(run) for run in runs])
        for run in runs:
            for s in run:
                self.numbers[s] = len(self.numbers)
        first = len(self.numbers) - len(valid)
        self.invalid.update(first + i for i, ok in enumerate(valid) if not ok)
        sizes_a, sizes_b = (np.diff(table.indptr)[flat] for table, flat in ((self.bytes_a, flat_a), (self.bytes_b, flat_b)))
        links = aligned(sizes_a, sizes_b)
        last_a = np.cumsum(n_a)
        # a stretch ends a group, so its groups are those up to its last token
        groups = np.diff(np.searchsorted(links.groups_a, np.concatenate([[0], last_a]), "left"))
        overlaps = np.bincount(np.searchsorted(last_a, links.overlap[0], "right"), minlength=len(n_a))
        left, right = links.overlap[0][links.ends], links.overlap[1][links.ends]
        for store, values, sizes in (
                (self.ids_a, flat_a, n_a), (self.ids_b, flat_b, n_b), (self.group_a, np.diff(links.groups_a), groups), (self.group_b, np.diff(links.groups_b), groups),
                (self.shared, links.overlap[2], overlaps), (self.pairs, flat_a[left].astype(np.int64) << 32 | flat_b[right], groups)):
            store.add(values, sizes)

    def told(self) -> list[str]:
        """The groups of every stretch as text, ``a1,a2|b1;a3|b2``; written when they are asked for, as only one pass needs them."""
        first = len(self.groups_text)
        if first < len(self.numbers):
            ids_a, ids_b, group_a, group_b = (rows.values[rows.indptr[first]:rows.used] for rows in (self.ids_a, self.ids_b, self.group_a, self.group_b))
            self.groups_text.extend(_groups_text(ids_a, ids_b, group_a, group_b, np.diff(self.group_a.matrix().indptr[first:])))
        return self.groups_text

    def stretches(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the stretches of some texts, and the bounds of each text in them; invalid texts have none."""
        split = [CUT.split(t) if t else [] for t in texts]
        every = list(chain.from_iterable(split))
        known = list(map(self.numbers.get, every))
        new = [i for i, k in enumerate(known) if k is None]
        if new:
            self._learn(list(dict.fromkeys([every[i] for i in new])))
            for i in new:
                known[i] = self.numbers[every[i]]
        number = np.array(known, np.int64)
        bound = np.cumsum([0, *map(len, split)])
        if self.invalid:
            bad = np.isin(number, np.array(sorted(self.invalid)))
            owner = np.repeat(np.arange(len(texts)), np.diff(bound))
            keep = ~np.isin(owner, owner[bad])
            number, bound = number[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))])
        return number, bound


def _groups_text(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, groups: np.ndarray) -> list[str]:
    """The groups of each stretch as text, from the ids, how many of them each group has and how many groups each stretch has."""
    a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    cut_a, cut_b, bound = (np.concatenate([[0], np.cumsum(sizes)]).tolist() for sizes in (group_a, group_b, groups))
    every = [f"{a[i]}|{b[j]}" if k == i + 1 and m == j + 1 else f"{','.join(a[i:k])}|{','.join(b[j:m])}"
             for i, k, j, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
    return [";".join(every[x:y]) for x, y in zip(bound, bound[1:])]


def _portions(column: pa.Array):
    """Ranges of rows with about ``BATCH_BYTES`` of text, and their texts; a longer text comes alone."""
    first = 0
    while first < len(column):
        last, size = first, 0
        while last < len(column) and (last == first or size < BATCH_BYTES):
            size += len(column[last].as_py() or "")
            last += 1
        yield first, last, column.slice(first, last - first).to_pylist()
        first = last


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _sent(docs: DataFrame, vocabularies: Vocabularies | Broadcast) -> Broadcast:
    """The models as a broadcast value; passes that share one share what their workers remember."""
    return docs.sparkSession.sparkContext.broadcast(vocabularies) if isinstance(vocabularies, Vocabularies) else vocabularies


def alignments(docs: DataFrame, vocabularies: Vocabularies | Broadcast) -> DataFrame:
    """(doc_id, a_ids, b_ids, group_a, group_b, shared): both tokenizations of every text and their links.

    ``group_a`` and ``group_b`` hold how many A and B tokens each group has; the last tokens of a group are its end link, all A and B
    tokens of a group its shared-group links. ``shared`` holds the bytes of each overlap link, in order.
    """
    names = ["a_ids", "b_ids", "group_a", "group_b", "shared"]
    models = _sent(docs, vocabularies)

    def run(batches):
        encoder = models.value.opened()
        for batch in batches:
            for first, last, texts in _portions(batch.column(1)):
                if encoder.full():
                    encoder.forget()
                number, bound = encoder.stretches(texts)
                columns = []
                for rows in (encoder.ids_a, encoder.ids_b, encoder.group_a, encoder.group_b, encoder.shared):
                    values, sizes = take_rows(rows.matrix(), number)
                    total = np.concatenate([[0], np.cumsum(sizes)])
                    columns.append(_lists(values, np.diff(total[bound]), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def pair_counts(docs: DataFrame, vocabularies: Vocabularies | Broadcast) -> DataFrame:
    """(pair, links, best): how many end links each pair of ids has, and whether that is the highest of its B id."""
    models = _sent(docs, vocabularies)

    def run(batches):
        encoder = models.value.opened()
        times = np.zeros(0, np.int64)  # of each stretch that the encoder remembers
        for batch in batches:
            for _, _, texts in _portions(batch.column(0)):
                if encoder.full():
                    yield summed(encoder, times)
                    encoder.forget()
                    times = times[:0]
                number, _ = encoder.stretches(texts)
                own = np.bincount(number, minlength=len(encoder.numbers))
                own[:len(times)] += times
                times = own
        yield summed(encoder, times)

    def summed(encoder, times):
        some = np.flatnonzero(times)
        pairs, sizes = take_rows(encoder.pairs.matrix(), some)
        pair, at = np.unique(pairs, return_inverse=True)
        links = np.zeros(len(pair), np.int64)
        np.add.at(links, at, np.repeat(times[some], sizes))
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(links)], ["pair", "links"])

    counts = docs.select("text").mapInArrow(run, "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))
    counts = stored(counts, "pair-counts")
    token = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(token.alias("token")).agg(F.max("links").alias("highest"))
    return stored(counts.withColumn("token", token).join(highest, "token").select("pair", "links", (F.col("links") == F.col("highest")).alias("best")), "pairs")


class Settled:
    """What the frequent pairs settle of each stretch that an encoder remembers, kept up with it."""

    def __init__(self, encoder: Encoder, pairs: np.ndarray, links: np.ndarray, best: np.ndarray):
        self.encoder, self.known, self.links, self.best = encoder, pairs, links, best
        self.sums, self.rest = np.zeros((5, 0), np.int64), Rows(np.int64)

    def sync(self) -> None:
        encoder = self.encoder
        n = encoder.pairs.count
        if n < self.sums.shape[1]:
            self.sums, self.rest = self.sums[:, :0], Rows(np.int64)
        done = self.sums.shape[1]
        if n == done:
            return
        new = np.arange(done, n)
        pair, groups = take_rows(encoder.pairs.matrix(), new)
        sizes = [np.diff(rows.matrix().indptr[done:]) for rows in (encoder.ids_a, encoder.ids_b)]
        owner = np.repeat(new - done, groups)
        best, links, hit = np.zeros(n - done, np.int64), np.zeros(n - done, np.int64), np.zeros(len(pair), bool)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, pair), len(self.known) - 1)
            hit = self.known[at] == pair
            np.add.at(best, owner[hit], self.best[at[hit]].astype(np.int64))
            np.add.at(links, owner[hit], self.links[at[hit]])
        self.sums = np.concatenate([self.sums, np.stack([*sizes, groups, best, links])], axis=1)
        self.rest.add(pair[~hit], np.bincount(owner[~hit], minlength=n - done))


_SUMS = ("n_a", "n_b", "n_groups", "n_best", "count_sum")


def link_strengths(docs: DataFrame, vocabularies: Vocabularies | Broadcast, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text)."""
    # at most `frequent` rows of three numbers
    top = counts.orderBy(F.desc("links"), "pair").limit(frequent).toPandas().sort_values("pair")
    known = top["pair"].to_numpy(np.int64), top["links"].to_numpy(np.int64), top["best"].to_numpy(bool)
    models = _sent(docs, vocabularies)
    rest_type = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))

    def run(batches):
        encoder = models.value.opened()
        settled = Settled(encoder, *known)
        for batch in batches:
            for first, last, texts in _portions(batch.column(1)):
                if encoder.full():
                    encoder.forget()
                    settled = Settled(encoder, *known)
                number, bound = encoder.stretches(texts)
                settled.sync()
                sums = np.zeros((5, len(number) + 1), np.int64)
                np.cumsum(settled.sums[:, number], axis=1, out=sums[:, 1:])
                pair, sizes = take_rows(settled.rest.matrix(), number)
                total = np.concatenate([[0], np.cumsum(sizes)])
                owner = np.repeat(np.arange(last - first), np.diff(total[bound]))
                order = np.lexsort((pair, owner))
                owner, pair = owner[order], pair[order]
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                each = np.searchsorted(owner[at], np.arange(last - first + 1)).astype(np.int32)
                copies = np.diff(np.append(at, len(pair)))
                rest = pa.ListArray.from_arrays(pa.array(each), pa.StructArray.from_arrays([pa.array(pair[at]), pa.array(copies.astype(np.int64))], ["pair", "n"]))
                text, parts = encoder.told(), number.tolist()
                digests = [hashlib.sha256(";".join([text[k] for k in parts[x:y]]).encode()).hexdigest() if y > x else "" for x, y in zip(bound.tolist(), bound[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *map(pa.array, np.diff(sums[:, bound], axis=1)), pa.array(digests, pa.string()), rest.cast(rest_type)],
                    ["doc_id", *_SUMS, "groups_sha256", "rest"])

    kinds = f"doc_id long, {', '.join(f'{c} long' for c in _SUMS)}, groups_sha256 string, rest array<struct<pair:long,n:long>>"
    near = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kinds)
    near = stored(near.withColumn("row", F.monotonically_increasing_id()), "settled-links")
    far = near.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.n").join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("links")).alias("more"))
    nothing = F.lit(0).cast("long")
    return near.drop("rest").join(far, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), (F.col("n_best") + F.coalesce("more_best", nothing)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", nothing)).alias("count_sum"), "groups_sha256")


def token_alignment(docs: DataFrame, vocabularies: Vocabularies, *, frequent: int = FREQUENT) -> DataFrame:
    """Counts of tokens, groups and links of every row of ``docs``, how common its links are, and a digest of its groups."""
    models = _sent(docs, vocabularies)
    return link_strengths(docs, models, pair_counts(docs, models), frequent)
