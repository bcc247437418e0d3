"""Language of texts by error-correcting output codes over binary n-gram classifiers.

* Every learned language gets a codeword: a row of a Sylvester-Hadamard matrix without the columns that do not part the
  languages. Any two codewords of ``N`` columns differ in about ``N / 2`` bits, so some wrong bits are corrected.
* Each bit has a classifier: multinomial naive Bayes over n-grams of 2 to 4 characters, with the log ratio of an n-gram's
  smoothed share in the languages whose bit is 1 to that in the others. Every bit weighs its languages alike, however many
  texts they have. N-grams are hashed into ``2 ** BITS`` buckets, which is the only bound on them; their counts come from
  all training texts, whole, and are summed by language and bucket before they travel.
* A text's margin at a bit is the sum of its ratios over the square root of its n-grams. Decoding weighs each bit's logistic loss by how
  often the bit is right for the language (measured on at most ``rows`` training texts, those with the smallest hash of ``doc_id``) and chooses
  the codeword with the least loss. ``score`` is the share of that codeword, by the likelihoods of all.
* ``ambiguous`` marks texts whose bits lie farther from the codeword than the code corrects for sure, or with ``score`` below 0.5 plus ``AMBIGUOUS``.

A text that is null or has no letter is ``und`` with score 0. Without any training text everything is ``und``; with one language all
texts get it, with score 1. A-Z count as a-z; characters that are no letters count as one blank where they are ASCII. Texts of any
length are read whole; repeated rows train and are predicted as often as they stand; extra columns are ignored.
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

BITS = 16
GRAMS = (2, 3, 4)
TRAINING_ROWS = 20_000
AMBIGUOUS = 0.1
UNKNOWN = "und"
LETTERLESS = np.ones(256, bool)  # ASCII bytes that are no letters
LETTERLESS[0x80:] = False
LETTERLESS[0x41:0x5B] = LETTERLESS[0x61:0x7B] = False


def codewords(languages: int) -> np.ndarray:
    """(languages, bits) of 0 and 1."""
    size = 8
    while size <= languages:
        size *= 2
    rows, columns = np.arange(1, languages + 1), np.arange(1, size)
    bits = np.array([[bin(r & c).count("1") & 1 for c in columns] for r in rows], np.int8).reshape(languages, size - 1)
    return bits[:, bits.min(axis=0) != bits.max(axis=0)] if languages else bits[:, :0]


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # (languages, bits) of 0 and 1
    weights: np.ndarray  # (bits, buckets)
    trust: np.ndarray  # (languages, bits), rows add up to 1


def _grams(column, powers: Powers):
    """By chunk: the bucket of every n-gram, the document of each, and the range of rows."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        part = np.where(LETTERLESS[part], np.uint8(0x20), part)
        begin = np.append(np.flatnonzero((part & 0xC0) != 0x80), len(part))  # of characters
        bound = np.searchsorted(begin, own)
        owner = np.repeat(np.arange(last - first), np.diff(bound))
        hasher = Hasher(byte_symbols(part, lower=True), powers)
        buckets, owners = [], []
        for size in GRAMS:
            n = len(begin) - size
            if n <= 0:
                continue
            whole = np.flatnonzero(np.arange(n) + size <= bound[owner[:n] + 1])
            hashes = hasher.spans(begin[whole], begin[whole + size])
            buckets.append((hashes >> np.uint64(64 - BITS)).astype(np.int32))
            owners.append(owner[whole])
        if buckets:
            yield buckets, owners, first, last


def _counts(training: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all training rows (lang, text)."""
    def run(batches):
        powers, held = Powers(), {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for buckets, owners, first, last in _grams(batch.column(1), powers):
                kinds = {}
                number = np.array([kinds.setdefault(x, len(kinds)) for x in langs[first:last]])
                counts = np.zeros((len(kinds), 1 << BITS), np.int64)
                for bucket, owner in zip(buckets, owners):
                    counts += np.bincount((number[owner] << BITS) + bucket, minlength=counts.size).reshape(counts.shape)
                for lang, k in kinds.items():
                    held[lang] = held[lang] + counts[k] if lang in held else counts[k]
            if len(held) > 64:
                yield from _summed(held)
                held = {}
        yield from _summed(held)

    def _summed(held):
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(counts[some])], ["lang", "bucket", "n"])

    return training.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def margins(column, powers: Powers, weights: np.ndarray) -> np.ndarray:
    """(rows, bits): each text's margin at each bit."""
    sums, n = np.zeros((len(column), len(weights))), np.zeros(len(column))
    for buckets, owners, first, last in _grams(column, powers):
        for bucket, owner in zip(buckets, owners):
            bound = np.searchsorted(owner, np.arange(last - first + 1))
            some = np.flatnonzero(np.diff(bound))
            n[first:last] += np.diff(bound)
            for bit, ratios in enumerate(weights):
                if len(some):
                    sums[first + some, bit] += np.add.reduceat(ratios[bucket], bound[some], dtype=np.float64)
    return sums / np.sqrt(np.maximum(n, 1))[:, None]


def decoded(margin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen language, its share and whether the choice is ambiguous, for margins (rows, bits)."""
    sign = model.codes.astype(float) * 2 - 1
    loss = np.zeros((len(margin), len(sign)))
    for k, (signs, trust) in enumerate(zip(sign, model.trust)):
        loss[:, k] = (np.logaddexp(0, -margin * signs) * trust).sum(axis=1)
    best = loss.argmin(axis=1)
    share = np.exp((loss.min(axis=1, keepdims=True) - loss) * margin.shape[1])
    score = 1 / share.sum(axis=1)
    apart = min([int((a != b).sum()) for i, a in enumerate(model.codes) for b in model.codes[:i]], default=1)
    wrong = ((margin > 0) != (model.codes[best] == 1)).sum(axis=1)
    return best, score, (wrong > (apart - 1) // 2) | (score < 0.5 + AMBIGUOUS)


def _trust(sample: DataFrame, model: Model) -> np.ndarray:
    """How often each bit is right for each language, smoothed, each language's bits adding up to 1."""
    number = {lang: k for k, lang in enumerate(model.languages)}

    def run(batches):
        powers = Powers()
        right, seen = np.zeros(model.codes.shape, np.int64), np.zeros(len(model.codes), np.int64)
        for batch in batches:
            k = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            fit = (margins(batch.column(1), powers, model.weights) > 0) == (model.codes[k] == 1)
            np.add.at(right, k, fit.astype(np.int64))
            np.add.at(seen, k, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(seen)), pa.int64()), pa.array(seen), pa.array(right.tolist(), pa.list_(pa.int64()))], ["language", "seen", "right"])

    rows = sample.select("lang", "text").mapInArrow(run, "language long, seen long, right array<long>")
    sums = rows.groupBy("language").agg(F.sum("seen").alias("seen"), *[F.sum(F.col("right")[b]).alias(f"b{b}") for b in range(model.codes.shape[1])])
    trust = np.full(model.codes.shape, 1.0)
    for r in sums.collect():
        trust[r["language"]] = [(r[f"b{b}"] + 1) / (r["seen"] + 2) for b in range(trust.shape[1])]
    return trust / trust.sum(axis=1, keepdims=True)


def train(docs: DataFrame, where: Column, *, rows: int = TRAINING_ROWS) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) for which ``where`` holds and that have a language and a text."""
    training = docs.where(where & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    counts = stored(_counts(training), "language-counts")
    # one row of a bounded number of buckets for each language
    table = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).orderBy("lang").toArrow()
    languages = table.column("lang").to_pylist()
    codes = codewords(len(languages))
    shares = np.full((len(languages), 1 << BITS), 0.0)
    for k, found in enumerate(table.column("counts")):
        own = found.values
        shares[k, np.asarray(own.field("bucket"))] = np.asarray(own.field("n"))
    # half an n-gram of each bucket more, so that every language has seen all of them
    shares = (shares + 0.5) / (shares.sum(axis=1, keepdims=True) + 0.5 * (1 << BITS))
    weights = np.array([np.log(shares[c == 1].mean(axis=0)) - np.log(shares[c == 0].mean(axis=0)) for c in codes.T], np.float32)
    model = Model(languages, codes, weights.reshape(codes.shape[1], 1 << BITS), np.full(codes.shape, 1 / max(codes.shape[1], 1)))
    if codes.shape[1]:
        chosen = training.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        model.trust = _trust(training.join(chosen, "doc_id"), model)
    return model


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``; columns of these names are replaced."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    own = docs.select(*names, letters.alias("_language_known"))
    at = names.index("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    models = docs.sparkSession.sparkContext.broadcast(model)  # of a size set by BITS and the number of languages

    def run(batches):
        powers, model = Powers(), models.value
        for batch in batches:
            n = batch.num_rows
            known = np.asarray(batch.column(len(names)).to_pylist(), bool) & bool(model.languages)
            if model.codes.shape[1]:
                best, score, unsure = decoded(margins(batch.column(at), powers, model.weights), model)
            else:
                best, score, unsure = np.zeros(n, int), np.ones(n), np.zeros(n, bool)
            pred = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(pred, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(unsure | ~known)],
                [*names, "lang_pred", "score", "ambiguous"])

    return own.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")


def fifth(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def language_of(docs: DataFrame, *, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous): trained on documents outside the fold that is held out."""
    model = train(docs, F.coalesce(fifth(F.col("doc_id")) != 0, F.lit(False)), rows=rows)
    found = predicted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return found.select("doc_id", F.coalesce(fifth(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
