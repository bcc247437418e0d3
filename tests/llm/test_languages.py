"""Language identification: codes, features and decoding against plain versions, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assaylake.llm import languages
from assaylake.llm.anchors import Powers
from assaylake.llm.queries import QUERIES
from tests.llm.helpers import edge_docs, no_docs


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 20, 60])
def test_codewords_lie_far_apart(n):
    codes = languages.codewords(n)
    assert len(codes) == n
    if n > 1:
        assert (codes.min(axis=0) < codes.max(axis=0)).all()
        full = 8 if n < 8 else 1 << n.bit_length()
        assert all((a != b).sum() >= full // 2 for i, a in enumerate(codes) for b in codes[:i])


def plain_grams(text):
    chars = [c if ord(c) > 127 else c.lower() if c.isalpha() else " " for c in text]
    return ["".join(chars[i:i + n]) for n in languages.GRAMS for i in range(len(chars) - n + 1)]


def bucket(gram):
    found = [b for buckets, *_ in languages._grams(pa.array([gram]), Powers()) for b in buckets[len(gram) - 2].tolist()]
    assert len(found) == 1
    return found[0]


TEXTS = {"xx": ["kala mela kala", "ka la me", "mela"], "yy": ["strun grust strun", "strunt"], "zz": ["\u00e9\u00fc\u00e9 \u00fc\u00e9", "\u00e9\u00fc strun", "\u00fc\u00e9 1 2"]}


def test_margins_and_decoding_against_plain_loops(spark):
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, texts in TEXTS.items() for t in texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.train(docs, F.lit(True))
    assert model.languages == ["xx", "yy", "zz"]
    known, slots = Powers(), 1 << languages.BITS
    counts = {lang: Counter(bucket(g) for t in texts for g in plain_grams(t)) for lang, texts in TEXTS.items()}
    share = {lang: lambda b, c=c: (c[b] + 0.5) / (sum(c.values()) + 0.5 * slots) for lang, c in counts.items()}

    def margin(text, bit):
        sides = [[lang for lang, code in zip(model.languages, model.codes) if code[bit] == side] for side in (0, 1)]
        mean = [lambda b, s=s: sum(share[x](b) for x in s) / len(s) for s in sides]
        grams = [bucket(g) for g in plain_grams(text)]
        return sum(math.log(mean[1](b) / mean[0](b)) for b in grams) / math.sqrt(max(len(grams), 1))

    asked = ["kala strun", "\u00e9\u00fc", "me", "STRUN!", "x"]
    found = languages.margins(pa.array(asked), known, model.weights)
    plain = np.array([[margin(t, b) for b in range(model.codes.shape[1])] for t in asked])
    assert np.allclose(found, plain, atol=1e-4)
    right = np.zeros(model.codes.shape)
    for lang, texts in TEXTS.items():
        k = model.languages.index(lang)
        for t in texts:
            right[k] += [(margin(t, b) > 0) == bool(model.codes[k][b]) for b in range(model.codes.shape[1])]
    trust = np.array([(r + 1) / (len(TEXTS[lang]) + 2) for lang, r in zip(model.languages, right)])
    assert np.allclose(model.trust, trust / trust.sum(axis=1, keepdims=True))
    best, score, _ = languages.decoded(found, model)
    for row, k, s in zip(plain, best, score):
        losses = [sum(w * math.log1p(math.exp(-m if c else m)) for m, c, w in zip(row, code, tr)) for code, tr in zip(model.codes, model.trust)]
        assert losses[k] == min(losses)
        assert math.isclose(s, 1 / sum(math.exp((min(losses) - x) * len(row)) for x in losses), abs_tol=1e-4)


def test_wrong_bits_are_corrected_and_flagged():
    codes = languages.codewords(4)
    model = languages.Model(list("abcd"), codes, np.zeros((codes.shape[1], 1)), np.full(codes.shape, 1 / codes.shape[1]))
    margin = (codes * 2.0 - 1) * 3
    one = margin.copy()
    one[:, 0] *= -0.2
    assert languages.decoded(margin, model)[0].tolist() == languages.decoded(one, model)[0].tolist() == [0, 1, 2, 3]
    assert not languages.decoded(margin, model)[2].any()
    assert languages.decoded(np.zeros((1, codes.shape[1])), model)[2].all()


def test_held_out_accuracy(spark):
    table = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op11_language_id"](spark, table).collect()}
    rows = spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {r["doc_id"] for r in out} == {i for i, r in got.items() if r["held_out"]}
    lettered = [r for r in out if any(c.isalpha() for c in r["text"])]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in lettered)
    assert right >= 0.95 * len(lettered)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_held_out_rows_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(languages.fifth(F.col("doc_id")) == 0, "qq").otherwise(F.col("lang")))
    assert sorted(languages.language_of(docs).collect()) == sorted(languages.language_of(other).collect())


def test_awkward_rows(spark):
    got = languages.language_of(edge_docs(spark).withColumn("ambiguous", F.lit(1)))
    rows = {(r["doc_id"], r["lang_pred"]) for r in got.collect()}
    assert (1, "und") in rows and (2, "und") in rows and (3, "und") in rows and (None, "und") in rows
    assert got.count() == edge_docs(spark).count()
    assert languages.language_of(no_docs(spark)).count() == 0
    unlabelled = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in languages.language_of(unlabelled).collect()} == {("und", 0.0)}
    single = languages.language_of(edge_docs(spark).where("text is not null"))
    assert {r["score"] for r in single.collect()} <= {0.0, 1.0}
