"""Near-duplicate groups against brute force."""

import random
import re

import numpy as np

from assaylake.llm import minhash
from assaylake.llm.minhash import near_duplicates, pairs_in_list
from tests.llm.helpers import docs, edge_docs, edge_rows, no_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def truth(rows, width=3, percent=85):
    """(doc_id, n_shingles, component_id, kept), by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and None not in (sets[x][0], sets[y][0]) and 100 * len(a & b) >= percent * len(a | b):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    out = []
    for x, (i, s) in enumerate(sets):
        group = None if i is None else least[root(x)]
        out.append((i, len(s), group, i is None or group == i))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def near_copies(seed, bases, copies, words):
    rng = random.Random(seed)
    out = {}
    for _ in range(bases):
        base = [f"v{rng.randint(0, 400)}" for _ in range(words)]
        for _ in range(copies):
            share = rng.random() * 0.12
            text = [w if rng.random() > share else f"v{rng.randint(0, 40)}" for w in base]
            out[len(out) * 2 + 7] = " ".join(text) + rng.choice(["", " ", "\n"])
    return out


def test_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 20)  # lists are cut into blocks
    monkeypatch.setattr(minhash, "TASK_ROWS", 300)
    texts = near_copies(5, 4, 45, 90) | {1000 + i: f"alone{i} in its own words {i} here" for i in range(20)}
    got = rows_of(near_duplicates(docs(spark, texts)))
    want = truth(list(texts.items()))
    assert got == want
    assert sum(not r[3] for r in want) > 20 and sum(r[3] for r in want) > 30


def test_registered_query(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert rows_of(near_duplicates(table)) == truth(rows)


def test_awkward_rows(spark):
    assert rows_of(near_duplicates(edge_docs(spark))) == truth([r[:2] for r in edge_rows()])
    assert near_duplicates(no_docs(spark)).count() == 0


def test_a_pair_is_looked_at_in_one_list():
    members = [np.arange(100), np.arange(100), np.arange(100) + 1, np.arange(40)]
    ids, groups = np.array([1, 2, 3, 4]), np.array([1, 2, 3, 4])
    before = [np.array([5]), np.array([6]), np.array([5]), np.array([], np.int64)]
    assert set(pairs_in_list(members, before, ids, groups, None, 85)) == {(0, 1), (1, 2)}
    assert set(pairs_in_list(members, before, ids, np.array([1, 1, 3, 4]), None, 85)) == {(1, 2)}
    assert set(pairs_in_list(members, before, ids, groups, np.array([0, 0, 1, 1]), 85)) == {(1, 2)}
