"""Both substring operators against brute force, over small windows that meet every case, and over awkward rows."""

import hashlib
import re

import pytest

from assaylake.llm import phrases, suffixes
from tests.llm.helpers import copied_texts, docs, edge_docs, edge_rows, no_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def phrase_truth(rows, window):
    """(doc_id, n_words, n_removed, kept_sha256) by looking at every window of every row."""
    first = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for j in range(len(words) - window + 1):
            key = tuple(words[j:j + window])
            if i is not None and first.get(key, i) >= i:
                first[key] = i
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for j in range(len(words) - window + 1):
            if i is not None and first[tuple(words[j:j + window])] < i:
                gone.update(range(j, j + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), sha(" ".join(kept).encode())))
    return sorted(out, key=repr)


def suffix_truth(rows, window):
    starts = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, data in texts:
        for j in range(len(data) - window + 1):
            starts[data[j:j + window]] = starts.get(data[j:j + window], 0) + 1
    out = []
    for i, data in texts:
        gone = [False] * len(data)
        for j in range(len(data) - window + 1):
            if starts[data[j:j + window]] > 1:
                gone[j:j + window] = [True] * window
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed, window, gram, hot", [(1, 6, 3, 1000), (2, 7, 3, 2)])
def test_phrases(spark, monkeypatch, seed, window, gram, hot):
    monkeypatch.setattr(phrases, "AUTOMATON_SEGMENTS", 5)
    texts = copied_texts(seed, 160, ["a", "bb", "c", "dd", "é"], 40)
    got = phrases.repeat_counts(docs(spark, texts), window=window, gram=gram, hot=hot, shard_segments=50)
    assert rows_of(got) == phrase_truth(list(texts.items()), window)


@pytest.mark.parametrize("seed, window, gram", [(1, 12, 4), (2, 20, 5), (3, 9, 3)])
def test_suffixes(spark, seed, window, gram):
    texts = copied_texts(seed, 160, ["ab", "ba", "aab", "é"], 40)
    got = suffixes.repeat_counts(docs(spark, texts), window=window, gram=gram)
    assert rows_of(got) == suffix_truth(list(texts.items()), window)


def test_registered_phrases_and_suffixes(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    table = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows_of(phrases.repeat_counts(table)) == phrase_truth(rows, 50)
    assert rows_of(suffixes.repeat_counts(table)) == suffix_truth(rows, 200)


def test_awkward_rows(spark):
    rows = [r[:2] for r in edge_rows()]
    assert rows_of(phrases.repeat_counts(edge_docs(spark))) == phrase_truth(rows, 50)
    assert rows_of(suffixes.repeat_counts(edge_docs(spark))) == suffix_truth(rows, 200)
    assert phrases.repeat_counts(no_docs(spark)).count() == 0
    assert suffixes.repeat_counts(no_docs(spark)).count() == 0


def test_kept_text_keeps_what_stood_between(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    got = phrases.without_repeats(docs(spark, {1: f"start\n{passage}  end", 2: f"\tmine {passage}\n\nrest", 3: f"{passage} ", 4: None}))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: f"start\n{passage}  end", 2: "\tmine rest", 3: "", 4: None}
    assert phrases.without_repeats(edge_docs(spark)).columns == edge_docs(spark).columns


def test_equal_windows_of_a_hot_anchor_are_searched_once(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(9))
    texts = {i: f"a{i} b{i} c{i} {passage} d{i} e{i} f{i}" for i in range(60)}
    seen, search = [], phrases._search

    def watched(shards, *rest):
        seen.extend(shards.select("anchor", "words").collect())
        return search(shards, *rest)

    monkeypatch.setattr(phrases, "_search", watched)
    got = rows_of(phrases.repeat_counts(docs(spark, texts), window=6, gram=3, hot=2))
    assert got == phrase_truth(texts.items(), 6)
    assert len(seen) == len(set(seen)) and sum(r["words"] == "p1 p2 p3 p4 p5 p6" for r in seen) == 1


@pytest.mark.parametrize("line, lines, most", [("one two three", 12000, 60), ("one two three four five six seven eight nine ten eleven", 3000, 25_000)])
def test_a_repeated_line_makes_no_more_rows_than_segments(spark, monkeypatch, line, lines, most):
    texts = {1: f"{line} a b {line} {line}", 2: " ".join([line] * lines), 3: f"x {line} " + " ".join([line] * (lines - 900)) + " y", 4: f"{line} four five"}
    spans, make = [], phrases.repeated_spans

    def watched(*args, **options):
        out = make(*args, **options)
        spans.extend(out.collect())
        return out

    monkeypatch.setattr(phrases, "repeated_spans", watched)
    table = docs(spark, texts)
    got = rows_of(phrases.repeat_counts(table, window=6, gram=3))
    assert got == phrase_truth(texts.items(), 6)
    segments = phrases._segments(table.withColumn("digest", table.doc_id), 6, 3).count()
    assert sum(len(s["spans"]) for s in spans) <= min(segments, most)


def test_texts_without_a_match_are_not_shuffled(spark, monkeypatch):
    unique = [(i, " ".join(f"{i}w{j}" for j in range(60))) for i in range(400)]
    shared = [(1000 + i, f"own{i} " + " ".join(f"s{j}" for j in range(60))) for i in range(20)]
    met, likely = [], phrases._likely

    def marks(rows, found, keys):
        out = likely(rows, found, keys)
        met.append((out.count(), out.where("_likely").count(), found.count(), out.where("_likely").join(found, keys).count()))
        return out

    monkeypatch.setattr(phrases, "_likely", marks)
    rows = unique + shared + [(None, "no id"), (2000, None), (2000, "")]
    out = phrases.repeat_counts(spark.createDataFrame(rows, "doc_id long, text string"), window=50, gram=16)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(phrase_truth(rows, 50), key=str)
    assert len(met) == 2 and all(n in (420, 422, 423) and found == same <= kept <= found + 40 for n, kept, found, same in met)
    # texts that cannot match go past the join
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def test_bitmap_loses_no_key(spark, monkeypatch):
    rows = spark.range(20000).selectExpr("if(id % 7 = 0, null, id) as a", "id * id as b")
    found = rows.where("b % 5 = 0 and a is not null")
    for pieces, most in ((4096, 6200), (1, 20000)):
        monkeypatch.setattr(phrases, "BUCKETS", pieces)
        marked = phrases._likely(rows, found, ["a", "b"])
        assert marked.count() == 20000 and found.join(marked.where("_likely"), ["a", "b"]).count() == found.count()
        assert marked.where("_likely").count() <= most
