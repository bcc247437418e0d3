"""Documents with everything that may go wrong, and small helpers."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, doc string, spans int, key string, "
          "anchor int, score string, probability string, tokens int, component string, path string")

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(120_000))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, LONG), (6, passage), (6, passage), (7, "x " + passage + " y"), (None, passage),
        (None, None), (8, "one"), (9, "One"), (10, "one two"), (11, "ÀÉ   ñ 🎉🎉 　"), (12, "a" * 5000), (13, "b\u0000c d"),
    ]
    extra = ("x", "y", 1, "k", 2, "s", "p", 3, "c", None)
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None if t is None else len(t), *extra)
            for k, (i, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def copied_texts(seed, count, vocabulary, longest, passages=4, passage_words=12):
    """Texts over a small vocabulary that share passages and near copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice(vocabulary)
    shared = [[word() for _ in range(passage_words + rng.randint(0, 8))] for _ in range(passages)]
    out = {}
    for i in range(count):
        if out and rng.random() < 0.4:
            words = out[rng.choice(list(out))].split(" ")
            words = [w if rng.random() > 0.05 else word() for w in words]
        else:
            words = [word() for _ in range(rng.randint(0, longest))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(shared)
        out[i * 3 + 1] = " ".join(words)
    return out
