"""Words, anchors and the merge sort, each against a plain version."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from assaylake.llm.anchors import Hasher, Powers, segments
from assaylake.llm.sortmerge import adjacent, common, decoded, front_coded, merged
from assaylake.llm.words import byte_symbols, chunks, text_bytes, words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tabé\x1c　", max_size=12)), max_size=6))
def test_words_match_the_pattern(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = words_of(data, offsets)
    for i, text in enumerate(texts):
        own = [data[a:b].tobytes() for a, b in zip(words.start[words.first[i]:words.last[i]], words.end[words.first[i]:words.last[i]])]
        assert own == WORD.findall((text or "").encode())


def test_chunks_cover_all_documents_once():
    offsets = np.array([0, 5, 5, 900, 901, 905])
    assert [x for a, b in chunks(offsets, 10) for x in range(a, b)] == list(range(5))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=4))
def test_equal_windows_choose_equal_anchors(texts):
    window, gram = 8, 3
    offsets = np.cumsum([0, *map(len, texts)])
    hasher = Hasher(byte_symbols(np.frombuffer(b"".join(texts), np.uint8)), Powers())
    owner, lo, hi, at, anchor = segments(hasher, offsets[:-1], offsets[1:], window, gram)
    seen, chosen = 0, {}
    for row, a, b, place, value in zip(owner, lo, hi, at, anchor):
        for start in range(a, b + 1):
            text = b"".join(texts)[start:start + window]
            assert offsets[row] <= start and start + window <= offsets[row + 1]
            assert start <= place <= start + window - gram
            assert chosen.setdefault(text, (value, place - start)) == (value, place - start)
            seen += 1
    assert seen == sum(max(0, len(t) - window + 1) for t in texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 2 for x in b)), max_size=8), min_size=1, max_size=5))
def test_loser_tree_merges_front_coded_runs(runs):
    runs = [sorted(r) for r in runs]
    coded = []
    for r in runs:
        shared, sizes, tails = front_coded(r)
        coded.append(decoded(shared.tolist(), sizes.tolist(), tails))
    out = list(merged(coded))
    assert [s for s, _, _ in out] == sorted(s for r in runs for s in r)
    for (a, _, _), (b, shared, _) in zip(out, out[1:]):
        assert shared == common(a, b, 0)


def test_neighbours_across_partitions(spark, monkeypatch):
    from assaylake.llm import sortmerge

    monkeypatch.setattr(sortmerge, "PARTITION", 40)
    monkeypatch.setattr(sortmerge, "RUN", 25)
    rng = random.Random(3)
    strings = {i: bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for i in range(300)}
    found = adjacent(spark.createDataFrame([(i, bytearray(s)) for i, s in strings.items()], "id long, string binary")).collect()
    order = sorted(strings.values())
    got = sorted((strings[r["a"]], strings[r["b"]]) for r in found)
    assert got == sorted(zip(order, order[1:]))
    assert all(r["shared"] == common(strings[r["a"]], strings[r["b"]], 0) for r in found)
    assert adjacent(spark.createDataFrame([], "id long, string binary")).count() == 0


def test_what_lies_behind_the_mark(spark):
    rows = [(1, b"ab\xffxy"), (2, b"ab\xffxz"), (3, b"abc\xffx"), (4, b"b\xff")]
    found = {(r["a"], r["b"]): (r["shared"], r["beyond"])
             for r in adjacent(spark.createDataFrame([(i, bytearray(s)) for i, s in rows], "id long, string binary")).collect()}
    assert found == {(3, 1): (2, 1), (1, 2): (2, 1), (2, 4): (0, 0)}


def test_components(spark):
    from assaylake.llm.shared import components

    links = [(1, 2), (2, 3), (9, 3), (20, 21), (21, 22), (30, 30), *[(100 + i, 101 + i) for i in range(40)]]
    got = {r["id"]: r["component"] for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 9: 1, 21: 20, 22: 20, **{100 + i: 100 for i in range(1, 41)}}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0
