"""Substring dedup over words: repeated phrases, located by sharded Aho-Corasick automata.

A window is ``window`` consecutive words of one document. A word goes if a window that covers it also starts in a
document with a smaller id; windows are judged on the input.

1. Each window belongs to the anchor that its content chooses; the windows of a document fall into segments with one
   anchor each, and equal windows always lie in segments with equal anchors. Anchors of a single document are dropped.
2. Segments with equal content are confirmed as one recurring phrase and counted once, with their smallest id. Where
   all segments of an anchor are equal, they are wholly repeated and settled.
3. Else the windows of the anchor's distinct segments are the phrases to look for. Anchors are dealt over shards; each
   shard compiles automata of its phrases, a bounded number at a time, and streams its segments through them. That
   finds every occurrence of every phrase, and so the smallest id it starts in. As a document's windows can only recur
   under their own anchor, a document visits just the shards of its anchors. An anchor with more than ``hot`` distinct
   segments is dealt out window by window: each distinct window is searched once, with its smallest id, and its owner is
   joined back to the segments that hold it.
4. The phrases found lead back to all documents with such segments. Texts are shuffled only where a bitmap of the keys says that
   they may be needed.

Null ids and null or empty texts take no part and keep all words. Rows that agree in id and text get equal results; rows
with one id but different texts are judged apart and are no reason to remove words from each other.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.anchors import Hasher, Powers, equal_runs, segments
from assaylake.llm.shared import stored
from assaylake.llm.words import chunks, slices, text_bytes, word_hashes, words_of

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 50
GRAM = 16
SHARD_SEGMENTS = 4000  # distinct segments of a shard, about
AUTOMATON_SEGMENTS = 400  # distinct segments compiled at a time
HOT = 1000
BITS, BUCKETS = 16, 4096  # of the bitmap of keys: bits a key, and at most so many pieces of 4 KB; only speed depends on them
BITS, BUCKETS = 16, 4096  # of the bitmap of texts that a join needs: bits a text, and at most so many buckets of 4 KB; only speed depends on it


def _segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, content, doc_id, digest, lo, n, last): a document's windows by anchor; ``content`` is a hash of the words.

    Equal segments that follow each other, as in a repeated line, are one row, from ``lo`` to ``last``.
    """
    def run(batches):
        powers = Powers()
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last in chunks(offsets):
                own = offsets[first:last + 1] - offsets[first]
                part = data[offsets[first]:offsets[last]]
                words = words_of(part, own)
                hasher = Hasher(word_hashes(part, words, powers), powers)
                row, lo, hi, _, anchor = segments(hasher, words.first, words.last, window, gram)
                content = hasher.spans(lo, hi + window)
                begin, end = equal_runs(row, content, anchor)
                base = words.first[row[begin]]
                at = pa.array(first + row[begin])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[begin].view(np.int64)), pa.array(content[begin].view(np.int64)), batch.column(0).take(at),
                     batch.column(1).take(at), *[pa.array(x.astype(np.int32)) for x in (lo[begin] - base, (hi - lo + window)[begin], lo[end] - base)]],
                    ["anchor", "content", "doc_id", "digest", "lo", "n", "last"])

    return docs.where("doc_id is not null").select("doc_id", "digest", "text").mapInArrow(
        run, "anchor long, content long, doc_id long, digest long, lo int, n int, last int")


def _likely(docs: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` with ``_likely``: false only for rows whose keys are not in ``found``, which need not be shuffled to meet it.

    All tasks get a bitmap of hashed keys; a few other rows pass by chance.
    """
    pieces = max(1, min(BUCKETS, -(-found.count() * BITS >> 15)))
    place = F.pmod(F.xxhash64(*keys), F.lit(pieces << 15))
    piece, bit = F.shiftright(place, 15).alias("_piece"), place.bitwiseAND(F.lit((1 << 15) - 1))
    bits = found.select(piece, bit.alias("_bit")).groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = docs.withColumn("_piece", piece).join(F.broadcast(bits), "_piece", "left")
    return marked.select(*docs.columns, F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False)).alias("_likely"))


def _cut(needed: DataFrame, window: int, hot: int) -> DataFrame:
    """The words of the distinct segments that must be searched: (shard_key, anchor, content, base, owner, words, single).

    ``single`` rows are windows of hot anchors, with a hash of the window as ``shard_key``.
    """
    def run(batches):
        for batch in slices(batches):
            out = [[] for _ in _CUT]
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode("utf-8")
                words = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64))
                for w in wanted:
                    lo, n = w["lo"], w["n"]
                    pieces = [(0, n)] if w["variants"] <= hot else [(i, window) for i in range(n - window + 1)]
                    for base, size in pieces:
                        a, b = words.start[lo + base], words.end[lo + base + size - 1]
                        cut = b" ".join(data[a:b].split())
                        key = w["anchor"] if w["variants"] <= hot else int.from_bytes(hashlib.blake2b(cut, digest_size=8).digest(), "little", signed=True)
                        for column, value in zip(out, (key, w["anchor"], w["content"], base, w["owner"], cut.decode("utf-8"), w["variants"] > hot)):
                            column.append(value)
                        if len(out[0]) >= 2000:
                            yield _batch(out, _CUT)
                            out = [[] for _ in _CUT]
            yield _batch(out, _CUT)

    return needed.select("text", "wanted").mapInArrow(
        run, "shard_key long, anchor long, content long, base int, owner long, words string, single boolean")


_CUT = (("shard_key", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64()), ("base", pa.int32()), ("owner", pa.int64()), ("words", pa.string()), ("single", pa.bool_()))
_FOUND = (("anchor", pa.int64()), ("content", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("owner", pa.int64()), ("single", pa.bool_()))


def _batch(columns, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [name for name, _ in kinds])


def locate(phrases, texts, window: int):
    """Compile the windows of ``phrases`` (words, owner) and stream ``texts``: for each its (start, owner) hits.

    Words become characters, so one step of the automaton is one word; a window keeps its smallest owner.
    """
    import ahocorasick

    number: dict[str, str] = {}

    def letters(words: list[str]) -> str:
        for w in words:
            if w not in number:
                code = len(number) + 0x100
                number[w] = chr(code if code < 0xD800 else code + 0x800)
        return "".join([number[w] for w in words])

    automaton = ahocorasick.Automaton()
    for words, owner in phrases:
        text = letters(words)
        for i in range(len(text) - window + 1):
            phrase = text[i:i + window]
            if automaton.get(phrase, owner) >= owner:
                automaton.add_word(phrase, owner)
    automaton.make_automaton()
    unknown = chr(0xFF)
    for words in texts:
        # a word that no phrase holds ends every match
        yield [(end - window + 1, owner) for end, owner in automaton.iter("".join([number.get(w, unknown) for w in words]))]


def _search(shards: DataFrame, window: int, many: int) -> DataFrame:
    """(anchor, content, at, n, owner, single): runs of windows of a segment with the smallest id they start in."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(set(zip(*(table.column(c).to_pylist() for c in ("shard_key", "anchor", "content", "base", "owner", "words", "single")))))
        out = [[] for _ in _FOUND]
        begin = 0
        while begin < len(rows):
            # whole anchors up to the bound; one with more segments is compiled in turns and streamed through each
            end = begin
            while end < len(rows) and (end - begin < many or rows[end][0] == rows[end - 1][0]):
                end += 1
            words = [r[5].split(" ") for r in rows[begin:end]]
            best: list[dict[int, int]] = [{} for _ in words]
            for turn in range(0, len(words), many):
                phrases = [(w, r[4]) for w, r in zip(words[turn:turn + many], rows[begin + turn:begin + turn + many])]
                for have, hits in zip(best, locate(phrases, words, window)):
                    for at, owner in hits:
                        if have.get(at, owner) >= owner:
                            have[at] = owner
            for row, have in zip(rows[begin:end], best):
                run_start = run_owner = last = None
                for at in sorted(have):
                    if run_owner == have[at] and at == last + 1:
                        last = at
                        continue
                    if run_owner is not None:
                        _add(out, row, run_start, last, run_owner, window)
                    run_start = last = at
                    run_owner = have[at]
                if run_owner is not None:
                    _add(out, row, run_start, last, run_owner, window)
            begin = end
        return pa.Table.from_batches([_batch(out, _FOUND)])

    return shards.groupBy("shard").applyInArrow(run, "anchor long, content long, at int, n int, owner long, single boolean")


def _add(out, row, start, last, owner, window):
    for column, value in zip(out, (row[1], row[2], row[3] + start, last - start + window, owner, row[6])):
        column.append(value)


def repeated_spans(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, hot: int = HOT,
                   shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(doc_id, digest, spans): words that go, by runs of equal segments, as ``kept_mask`` takes them.

    ``docs`` has text, and doc_id and digest, a hash of the text, to tell texts apart.
    """
    known = stored(_segments(docs, window, gram), "segments")
    several = known.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    # written, so that a frequent anchor's rows can be split when they are joined
    several = stored(several.select("anchor"), "recurring-anchors")
    known = stored(known.join(several, "anchor", "left_semi"), "recurring-segments")
    distinct = known.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "digest", "lo", "n")).alias("first"), F.max("doc_id").alias("last"))
    distinct = stored(distinct, "distinct-segments")
    variants = distinct.groupBy("anchor").agg(F.count("*").cast("int").alias("variants"))
    plain = distinct.join(variants.where("variants = 1").select("anchor"), "anchor", "left_semi").select(
        "anchor", "content", F.lit(0).alias("at"), F.col("first.n").alias("n"), F.col("first.doc_id").alias("owner"))
    wanted = distinct.join(variants.where("variants > 1"), "anchor").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.digest").alias("digest"),
        F.struct("anchor", "content", F.col("first.lo").alias("lo"), F.col("first.n").alias("n"),
                 F.col("first.doc_id").alias("owner"), "variants").alias("w"))
    wanted = stored(wanted.groupBy("doc_id", "digest").agg(F.collect_list("w").alias("wanted")), "wanted-segments")
    texts = _likely(docs.select("doc_id", "digest", "text"), wanted, ["doc_id", "digest"]).where("_likely")
    needed = texts.join(wanted, ["doc_id", "digest"])
    cut = stored(_cut(needed, window, hot), "searched-segments")
    # equal windows are combined in the map tasks; the join back to all of them can be split
    columns = ["shard_key", "anchor", "content", "base", "owner", "words"]
    once = cut.where("single").groupBy("shard_key", "anchor", "words").agg(F.min("owner").alias("owner")).select(
        "shard_key", "anchor", F.col("shard_key").alias("content"), F.lit(0).alias("base"), "owner", "words")
    searched = stored(cut.where("not single").select(*columns, "single").unionAll(once.withColumn("single", F.lit(True))), "searched-once")
    shards = max(1, -(-searched.count() // shard_segments))
    found = stored(_search(searched.withColumn("shard", F.pmod(F.xxhash64("shard_key"), F.lit(shards))), window, AUTOMATON_SEGMENTS), "found")
    owners = found.where("single").select("anchor", F.col("content").alias("shard_key"), "owner")
    back = cut.where("single").select("shard_key", "anchor", "content", "base").join(owners, ["anchor", "shard_key"]).select(
        "anchor", "content", F.col("base").alias("at"), F.lit(window).alias("n"), "owner")
    phrases = plain.unionAll(found.where("not single").drop("single")).unionAll(back)
    # a segment has at most as many phrases as windows, so each segment stays one row
    phrases = stored(phrases.groupBy("anchor", "content").agg(
        F.min("owner").alias("low"), F.collect_set(F.struct("at", "n", "owner")).alias("found")), "phrases")
    # only segments of later documents lose words; a row of several equal segments is taken apart by `kept_mask`
    at = known.select("anchor", "content", "doc_id", "digest", "lo", "last", F.col("n").alias("size")).join(phrases, ["anchor", "content"])
    at = at.where(F.col("doc_id") > F.col("low")).select(
        "doc_id", "digest", F.struct("lo", "last", "size", F.expr(
            "transform(filter(found, f -> f.owner < doc_id), f -> struct(f.at as at, f.n as n))").alias("found")).alias("span"))
    return at.groupBy("doc_id", "digest").agg(F.collect_set("span").alias("spans"))


def kept_mask(count: int, spans, window: int) -> np.ndarray:
    """Which words stay.

    A span stands for equal segments of ``size`` words that begin at ``lo``, ... ``last``, each one window after the one
    before it; every one of them loses the words that ``found`` gives.
    """
    edge = np.zeros(count + 1, np.int64)
    for s in spans or ():
        step = s["size"] - window + 1
        for f in s["found"]:
            if f["n"] == s["size"]:
                edge[s["lo"]] += 1
                edge[s["last"] + f["n"]] -= 1
            else:
                edge[s["lo"] + f["at"]:s["last"] + f["at"] + 1:step] += 1
                edge[s["lo"] + f["at"] + f["n"]:s["last"] + f["at"] + f["n"] + 1:step] -= 1
    return np.cumsum(edge[:count]) == 0


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept words and what stood between them."""
    return _applied(docs, options, "text")


def repeat_counts(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row; the digest is over kept words joined by blanks."""
    return _applied(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), options, "counts")


def _applied(docs: DataFrame, options: dict, form: str) -> DataFrame:
    names, window = docs.columns, options.get("window", WINDOW)
    own = docs.select("*", F.col("doc_id").cast("long").alias("_phrase_doc"), F.xxhash64("text").alias("_phrase_digest"))
    spans = repeated_spans(own.select(F.col("_phrase_doc").alias("doc_id"), F.col("_phrase_digest").alias("digest"), "text"), **options)
    spans = stored(spans, "spans").toDF("_phrase_doc", "_phrase_digest", "_phrase_spans")
    keys = ["_phrase_doc", "_phrase_digest"]
    likely = _likely(own, spans, keys)
    nothing = F.lit(None).cast(spans.schema["_phrase_spans"].dataType).alias("_phrase_spans")
    joined = likely.where("_likely").join(spans, keys, "left").select(*names, "_phrase_spans").unionAll(
        likely.where("not _likely").select(*names, nothing))
    at = names.index("text")

    def cut(data: bytes, spans):
        words = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64))
        return words, kept_mask(len(words.start), spans, window)

    if form == "text":
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

        def run(batches):
            for batch in slices(batches):
                texts = []
                for text, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                    if text and spans:
                        data = text.encode("utf-8")
                        words, kept = cut(data, spans)
                        edge = np.diff(kept.astype(np.int8), prepend=1, append=1)
                        start = np.append(words.start, len(data))
                        gone = zip(start[np.flatnonzero(edge == -1)], start[np.flatnonzero(edge == 1)])
                        parts, held = [], 0
                        for a, b in gone:
                            parts.append(data[held:a])
                            held = b
                        text = b"".join([*parts, data[held:]]).decode("utf-8")
                    texts.append(text)
                columns = [batch.column(i) for i in range(len(names))]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

        return joined.mapInArrow(run, kinds)

    def count(batches):
        for batch in slices(batches):
            out = [[], [], []]
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                parts = (text or "").encode("utf-8").split()
                if spans:
                    kept = kept_mask(len(parts), spans, window)
                    left = [w for w, k in zip(parts, kept) if k]
                else:
                    left = parts
                for column, value in zip(out, (len(parts), len(parts) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("doc_id")), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(count, "doc_id long, n_words long, n_removed long, kept_sha256 string")
