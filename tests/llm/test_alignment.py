"""Token alignment against the libraries and plain loops over tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from assaylake.llm import alignment
from assaylake.llm.queries import QUERIES
from tests.llm.helpers import docs, edge_docs, edge_rows, no_docs

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def models():
    return alignment.load_vocabularies(*FILES)


def tokens(texts):
    """(A ids, B ids, bytes of A tokens, bytes of B tokens) of each text, by the libraries over whole texts."""
    a, b = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    printable = [c for c in range(256) if 0x20 < c < 0x7F or 0xA0 < c != 0xAD]
    rest = [c for c in range(256) if c not in printable]
    letters = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(rest)}
    out = []
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        found = a.encode(" " + text, add_special_tokens=False)
        bytes_a = [bytes(letters[c] for c in t) for t in found.tokens]
        ids_b = b.encode(text)
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ids_b]
        same = b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()
        out.append((found.ids, ids_b, bytes_a, bytes_b) if same else ([], [], [], []))
    return out


def groups_of(ids_a, ids_b, bytes_a, bytes_b):
    ends = []
    for side in (bytes_a, bytes_b):
        at, own = 0, []
        for t in side:
            at += len(t)
            own.append(at)
        ends.append(own)
    where = {e: j for j, e in enumerate(ends[1])}
    links = [(ids_a[i], ids_b[where[e]]) for i, e in enumerate(ends[0]) if e in where]
    groups = []
    cuts = [0, *(e for e in ends[0] if e in where)]
    at = [0, 0]
    for high in cuts[1:]:
        group = []
        for side, (ids, own) in enumerate(zip((ids_a, ids_b), ends)):
            first = at[side]
            while at[side] < len(own) and own[at[side]] <= high:
                at[side] += 1
            group.append(ids[first:at[side]])
        groups.append(group)
    return groups, links


def truth(rows):
    found = tokens([t for _, t in rows])
    every = [groups_of(*f) for f in found]
    counts = Counter(p for _, links in every for p in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (i, _), (a, b, _, _), (groups, links) in zip(rows, found, every):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


HARD = ["", None, " ", "  a  b ", "don't won't 'S x", "a<|endoftext|>b <s> <0x41>", "\u2581x y", "\U0001F389\U0001F389 \u00e9\u0301 \u00bd \u00b2",
        "line\nnext\r\n\tx 12 345  6", "\u3000wide \u3000x", "a" * 300, "\u4f60\u597d world", "x_y _z a. B, C", "\x00 \x1c a", "caf\u00e9 \u0645\u0631 \u0939\u093f"]


def test_hard_texts(spark, models):
    rows = list(enumerate(HARD)) + [(3, "  a  b "), (None, "again a b")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, pair int")
    assert got(alignment.token_alignment(table, models)) == truth(rows)


@pytest.mark.parametrize("frequent", [0, 3, 20_000])
def test_counts_do_not_depend_on_what_is_sent(spark, models, sf, frequent):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in table.collect()]
    assert got(alignment.token_alignment(docs(spark, dict(rows)), models, frequent=frequent)) == truth(rows)


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op12_token_alignment"](spark, sf)) == truth(rows)


def test_awkward_rows(spark, models, monkeypatch):
    assert got(alignment.token_alignment(edge_docs(spark), models)) == truth([r[:2] for r in edge_rows()])
    assert alignment.token_alignment(no_docs(spark), models).count() == 0


def test_products_against_dense_matrices():
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 60))
        cuts = [np.diff(np.unique(np.concatenate([[0, n], rng.integers(0, n, rng.integers(0, 20))]))) for _ in range(2)]
        links = alignment.aligned(*cuts)
        dense = [np.repeat(np.eye(len(c), dtype=int), c, axis=1) for c in cuts]
        product = dense[0] @ dense[1].T
        assert {(int(i), int(j)): int(v) for i, j, v in zip(*links.overlap)} == {(i, j): int(v) for (i, j), v in np.ndenumerate(product) if v}
        members = [np.repeat(np.eye(len(g) - 1, dtype=int), np.diff(g), axis=0) for g in (links.groups_a, links.groups_b)]
        shared = members[0] @ members[1].T
        for i, g in enumerate(links.shared):
            assert list(np.flatnonzero(shared[i])) == list(range(links.groups_b[g], links.groups_b[g + 1]))
    a, b = alignment.Csr(np.array([0, 2, 2, 3]), np.array([0, 2, 1]), 3), alignment.Csr(np.array([0, 1, 3, 5]), np.array([3, 0, 3, 0, 3]), 4)
    assert [tuple(map(int, e)) for e in zip(*alignment.row_products(a, b))] == [(0, 0, 1), (0, 3, 2), (2, 0, 1), (2, 3, 1)]


def test_links_are_returned(spark, models):
    row = alignment.alignments(docs(spark, {1: "hello worlds again"}), models).first()
    assert sum(row["shared"]) == len(" hello worlds again") and sum(row["group_a"]) == len(row["a_ids"]) and sum(row["group_b"]) == len(row["b_ids"])


def test_group_texts_are_written_when_asked_for(models):
    texts = ["one two three", "", None, "two  four\u2581five", "Größe ▁ 12,5 three", "one six"]
    parts, whole = alignment.Encoder(models), alignment.Encoder(models)
    whole.stretches(texts)
    assert whole.groups_text == []  # the pass that counts needs none
    for t in texts:
        parts.stretches([t])
        assert len(parts.told()) == len(parts.numbers)
    assert {s: parts.told()[k] for s, k in parts.numbers.items()} == {s: whole.told()[k] for s, k in whole.numbers.items()}
    number, bound = whole.stretches(texts)
    for i, (a, b, bytes_a, bytes_b) in enumerate(tokens(texts)):
        own = number[bound[i]:bound[i + 1]]
        told = [g.split("|") for g in ";".join(whole.told()[k] for k in own).split(";") if g]
        assert not len(own) or [",".join(map(str, ids)) for ids in (a, b)] == [",".join(side) for side in zip(*told)]
