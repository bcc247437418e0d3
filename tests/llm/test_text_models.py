"""Token counts beside the library's, toxicity on rows held out, alignment beside plain dynamic programming."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.llm.decontaminate import aligned, contaminated, item_words
from assaylake.llm.tokencount import Counter, load_vocabulary, token_counts
from assaylake.llm.toxicity import _fit, toxicity, train
from tests.llm.helpers import docs, edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def model_file():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model_file):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def test_counts_are_the_librarys(model_file, library):
    count = Counter(load_vocabulary(model_file))
    rng = random.Random(8)
    texts = ["", " ", "  a  b ", "\n\n x", "<s> </s> <unk>", "<0x41>", "日本語 テスト①", "a" * 3000, "▁▁ x ▁", " x　y", "\x00a", "🎉🎉 é", "ab\r\n\tcd", " " * 70]
    texts += ["".join(rng.choice("abcdefgehiort  \n\t▁éßд日<>/s.,;:!?01#'-") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    assert [count(t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_token_counts_of_tables(spark, sf, model_file, library):
    vocabulary = load_vocabulary(model_file)
    for table, rows in ((edge_docs(spark), edge_rows()), (spark.read.parquet(f"{sf}/documents.parquet"), None)):
        rows = rows or table.select("doc_id", "text").collect()
        want = sorted(((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "")), len(library.encode(r[1] or "")) > 4096) for r in rows), key=repr)
        assert sorted(map(tuple, token_counts(table, vocabulary).collect()), key=repr) == want
    assert token_counts(no_docs(spark), vocabulary).count() == 0


def labelled(spark, count, noise=0.0, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    bad = ["wretch", "vermin", "imbecile"]
    texts, labels = [], []
    for i in range(count):
        toxic = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        if toxic:
            for _ in range(2):
                text.insert(rng.randint(0, len(text)), rng.choice(bad).upper() if rng.random() < 0.3 else rng.choice(bad))
        texts.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic != (rng.random() < noise))))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = labelled(spark, 1500)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity(spark.createDataFrame(texts, "doc_id long, text string"), table).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [(got[i]["predicted"], t) for i, _, t in labels if got[i]["held_out"]]
    assert len(held) > 300 and sum(p != t for p, t in held) <= 0.02 * len(held)
    # labels of the fold held out change nothing
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = toxicity(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(turned, "doc_id long, quality int, toxic int"))
    assert {r["doc_id"]: r["predicted"] for r in again.collect()} == {i: r["predicted"] for i, r in got.items()}


def test_toxicity_awkward_rows(spark):
    schema = "doc_id long, quality int, toxic int"
    table = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (7, None, None), (None, 1, 1), (999, 1, 1), (12, 1, 0)], schema)
    got = toxicity(edge_docs(spark), table).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    untrained = toxicity(edge_docs(spark), spark.createDataFrame([], schema)).collect()
    assert {r["predicted"] for r in untrained} == {0}
    assert toxicity(no_docs(spark), table).count() == 0


def plain_alignment(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return int(table.max())


def test_alignment_scores():
    rng = random.Random(6)
    for _ in range(150):
        a = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 25))])
        b = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 15))])
        score, first, last = aligned(a, b)
        assert score == plain_alignment(a, b)
        assert plain_alignment(a[first:last], b) == score
    assert [len(w) for w in item_words(["A b", None, "", " a  B c"])] == [2, 0, 0, 3]
    assert item_words(["A b"])[0].tolist() == item_words(["a B"])[0].tolist()


def test_decontamination(spark):
    rng = random.Random(9)
    words = [f"q{i}" for i in range(60)] + ["the", "of", "and"] * 15
    items = {k: [rng.choice(words) for _ in range(rng.choice([2, 8, 20, 45]))] for k in range(12)}
    texts, want = {}, set()
    for i in range(240):
        text = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if i % 4 == 0:
            k = rng.randrange(12)
            if len(items[k]) >= 8:
                copy = [w if rng.random() > 0.08 or i % 8 else "edited" for w in items[k]]
                at = rng.randint(0, len(text))
                text[at:at] = copy
                want.add((i, k))
        texts[i] = " ".join(text)
    benchmark = spark.createDataFrame([(k, " ".join(v).upper() if k % 2 else " ".join(v)) for k, v in items.items()], "item_id long, text string")
    got = contaminated(docs(spark, texts), benchmark).collect()
    long_items = {k for k, v in items.items() if len(v) >= 20}
    assert {(r["doc_id"], r["item_id"]) for r in got if r["item_id"] in long_items} == {p for p in want if p[1] in long_items}
    for r in got:
        stretch = texts[r["doc_id"]].split()[r["first_word"]:r["last_word"]]
        hashes = item_words([" ".join(stretch), " ".join(items[r["item_id"]])])
        assert plain_alignment(*hashes) / (2 * len(items[r["item_id"]])) == r["similarity"] >= 0.6
    # exact copies anywhere are found whatever the number of items a pass takes
    slices = contaminated(docs(spark, texts), benchmark, slice_grams=300).collect()
    assert sorted(map(tuple, slices)) == sorted(map(tuple, got))


def test_decontamination_awkward_rows(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    benchmark = spark.createDataFrame([(1, passage), (2, passage), (3, None), (4, ""), (None, "one two"), (5, "nowhere at all to be found")], "item_id long, text string")
    got = contaminated(edge_docs(spark), benchmark).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"])) for r in got) == sorted(
        [(d, i) for d in ("6", "6", "7", "None") for i in ("1", "2")] + [("10", "None")])
    assert contaminated(no_docs(spark), benchmark).count() == 0
    assert contaminated(edge_docs(spark), benchmark.limit(0)).count() == 0
    assert contaminated(edge_docs(spark), benchmark.where(F.col("text") == "")).count() == 0


def test_edited_copies_with_one_seed_left(spark):
    rng = random.Random(10)
    items = {k: [f"i{k}w{j}" for j in range(n)] for k, n in enumerate([7, 8, 10, 15, 15, 20, 20, 38])}
    items[8] = ["again"] * 9  # one 3-gram over and over
    texts, want = {}, set()
    for i in range(180):
        k = i % 9
        copy = list(items[k])
        for at in rng.sample(range(len(copy)), max(1, len(copy) // 5) if k < 8 else 0):
            copy[at] = f"edited{i}x{at}"
        if i >= 90:  # and words between
            copy.insert(rng.randint(1, len(copy) - 1), f"between{i}")
        texts[i] = " ".join([f"before{i}x{j}" for j in range(5)] + copy + [f"after{i}x{j}" for j in range(5)])
        words = dict(enumerate(item_words([texts[i], " ".join(items[k])])))
        if plain_alignment(words[0], words[1]) >= 0.6 * 2 * len(items[k]):
            want.add((i, k))
    benchmark = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs(spark, texts), benchmark).collect()}
    assert len(want) > 150 and want == got


def test_a_short_item_with_one_word_changed(spark):
    item = [f"w{j}" for j in range(8)]
    edited = " ".join([item[0], "other", *item[2:]])
    got = contaminated(docs(spark, {1: edited, 2: " ".join(item)}), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {(r["doc_id"], r["similarity"]) for r in got.collect()} == {(1, 13 / 16), (2, 1.0)}


def test_a_model_keeps_more_than_the_commonest_features(spark):
    texts, labels = labelled(spark, 300)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = train(spark.createDataFrame(texts, "doc_id long, text string"), labels, F.lit(True))
    assert 10_000 < len(model.buckets) == len(model.weights) <= 30_000


def test_fitting_in_turns_is_fitting_at_once():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(40) < share) for share in rng.choice([0, 0.1, 0.5], 60)]
    bound = np.cumsum([0, *map(len, rows)])
    toxic = (rng.random(60) < 0.4).astype(float)
    found, ratios = np.concatenate(rows).astype(np.uint16), rng.normal(size=40)
    once = _fit(toxic, found, bound, ratios)
    turns = _fit(toxic, found, bound, ratios, pairs=7)
    assert np.allclose(once[0], turns[0]) and np.isclose(once[1], turns[1])
    # plain gradient steps over the whole matrix end at the same place
    table = np.zeros((60, 40))
    for i, row in enumerate(rows):
        table[i, row] = ratios[row]
    margin = table @ (once[0] / ratios) + once[1]
    error = (1 / (1 + np.exp(-margin)) - toxic) / 60
    assert np.abs(table.T @ error + 1e-4 * once[0] / ratios).max() < 0.01
