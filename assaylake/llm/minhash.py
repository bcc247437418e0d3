"""Near-duplicate groups by MinHash signatures whose coordinates are posted in an inverted index.

* A document's set is its distinct shingles of ``width`` lower-cased words (A-Z only); with fewer words, all
  of them as one shingle; without words, the empty set, which is linked with nothing. Null texts count as empty.
* Equal sets form one class and are linked without being paired; the rest works on one document a class.
* Each signature coordinate and value is one posting key. Keys that one class alone holds are dropped. Two
  classes that agree on ``matches`` of ``coordinates`` values share one of the rarest ``m - matches + 1`` of
  the ``m`` keys left to either, so only that prefix is posted and the frequent keys are skipped; the rest
  of the collisions are counted by comparing the two signatures.
* Pairs above the match threshold are confirmed on full sets, with integer arithmetic.
* A posting list is not paired in full. Each member meets the list's pivot, its most central member, and links found
  join groups. Members of a list that are still in different groups, and that hold enough shingles which occur
  elsewhere, are then compared inside tasks, large lists in blocks; only pairs that may be linked become rows.

With the defaults a pair of similarity 0.85 falls under the match threshold with a chance of about 4e-8; all
else is exact. The result does not depend on the partitioning. Equal rows are fine; ids shared by different texts
put those into one group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.anchors import Hasher, Powers, mixed
from assaylake.llm.shared import components, stored
from assaylake.llm.words import chunks, text_bytes, word_hashes, words_of

WIDTH = 3
COORDINATES = 40
MATCHES = 20
BLOCK = 2000  # members of a list that meet in one task
TASK_ROWS = 4_000


def shingle_sets(column, width: int, powers: Powers):
    """For each chunk of documents: distinct shingle hashes, where each document's begin, and the range of rows."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        words = words_of(part, own)
        count = words.last - words.first
        hasher = Hasher(word_hashes(part, words, powers, lower=True), powers)
        # whole shingles, then one for each document that has fewer words than a shingle
        room = np.maximum(count - width + 1, 0)
        owner = np.repeat(np.arange(last - first), room)
        at = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room) + np.repeat(words.first, room)
        few = np.flatnonzero((count > 0) & (count < width))
        owner = np.concatenate([owner, few])
        hashes = np.concatenate([hasher.grams(width)[at], hasher.spans(words.first[few], words.last[few])])
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
        owner, hashes = owner[fresh], hashes[fresh]
        yield hashes, np.searchsorted(owner, np.arange(last - first + 1)), first, last


def _signatures(docs: DataFrame, width: int, coordinates: int) -> DataFrame:
    """(doc_id, n_shingles, same, same2, signature): equal ``same`` and ``same2`` mean equal sets."""
    rng = np.random.default_rng(31337)
    factors = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1)
    terms = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64)

    def run(batches):
        powers = Powers()
        for batch in batches:
            ids = batch.column(0)
            for hashes, bound, first, last in shingle_sets(batch.column(1), width, powers):
                size = np.diff(bound)
                some = np.flatnonzero(size)
                begin = bound[:-1][some]
                signature = np.zeros((last - first, coordinates), np.uint64)
                same = np.zeros((2, last - first), np.uint64)
                if len(some):
                    for k in range(coordinates):
                        signature[some, k] = np.minimum.reduceat(hashes * factors[k] + terms[k], begin)
                    same[0, some] = np.add.reduceat(mixed(hashes), begin)
                    same[1, some] = np.bitwise_xor.reduceat(mixed(hashes + factors[0]), begin)
                # the coordinate's number becomes part of its key
                keys = mixed(signature + np.arange(coordinates, dtype=np.uint64) * factors[1]).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(last - first + 1, dtype=np.int32) * coordinates, keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(size.astype(np.int64)), pa.array(same[0].view(np.int64)),
                     pa.array(same[1].view(np.int64)), lists],
                    ["doc_id", "n_shingles", "same", "same2", "signature"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, same long, same2 long, signature array<long>")


def _sets(texts: DataFrame, width: int, spare: list[str]) -> DataFrame:
    """(spare columns, shingles): the full set beside other columns."""
    kinds = ", ".join(f"{n} {t}" for n, t in texts.select(*spare).dtypes)

    def run(batches):
        powers = Powers()
        for batch in batches:
            for hashes, bound, first, last in shingle_sets(batch.column(len(spare)), width, powers):
                lists = pa.ListArray.from_arrays(bound.astype(np.int32), hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(first, last - first) for i in range(len(spare))] + [lists], [*spare, "shingles"])

    return texts.select(*spare, "text").mapInArrow(run, f"{kinds}, shingles array<long>")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v, linked): pairs compared on full sets, in whole numbers.

    A document in many pairs is split by adaptive execution, as either side of the joins may be.
    """
    sets = _sets(texts, width, ["doc_id"])
    both = (pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("left")), "u")
            .join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("right")), "v"))
    shared = F.size(F.array_intersect("left", "right"))
    both = both.select("u", "v", shared.alias("shared"), (F.size("left") + F.size("right")).alias("sizes"))
    return both.select("u", "v", (F.col("shared") * 100 >= percent * (F.col("sizes") - F.col("shared"))).alias("linked"))


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, percent: int = 85,
                    coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): groups of documents linked by similarity.

    Linked: ``100 * shared >= percent * united`` over full shingle sets. ``docs`` needs ``doc_id`` and ``text``;
    other columns are ignored. Every row comes back once; a null ``doc_id`` stays alone, with a null group.
    """
    spark = docs.sparkSession
    signed = stored(_signatures(docs, width, coordinates), "signatures")
    classes = (signed.where("n_shingles > 0").groupBy("same", "same2", "n_shingles").agg(F.min("doc_id").alias("u"))
               .where("u is not null"))
    classes = stored(classes, "classes")
    groups = _class_groups(spark, docs, signed, classes, width, percent, matches)
    labelled = classes.join(groups, "u", "left").select(
        "same", "same2", "n_shingles", F.coalesce("component", "u").alias("component"))
    out = signed.select("doc_id", "n_shingles", "same", "same2").join(
        labelled, ["same", "same2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _class_groups(spark: SparkSession, docs: DataFrame, signed: DataFrame, classes: DataFrame, width: int,
                  percent: int, matches: int) -> DataFrame:
    """(u, component) for classes that are linked to another class."""
    ones = signed.join(classes.select(F.col("u").alias("doc_id"), "same"), ["doc_id", "same"], "left_semi").select(
        F.col("doc_id").alias("u"), "n_shingles", "signature")
    posted = ones.select("u", "n_shingles", F.explode("signature").alias("key"))
    often = posted.groupBy("key").agg(F.count("*").alias("often")).where("often > 1")
    mine = (posted.join(often, "key").groupBy("u", "n_shingles")
            .agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("keys"), F.count("*").alias("m"))
            .where(F.col("m") >= matches))
    mine = stored(mine, "survivors")
    lists = stored(mine.select("u", "n_shingles", "m", F.explode(F.slice("keys", 1, F.col("m") - matches + 1)).alias("k"))
                   .select("u", "n_shingles", "m", "k.key"), "postings")
    texts = stored(docs.select(F.col("doc_id").cast("long"), "text").join(
        mine.select(F.col("u").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "survivor-texts")
    signatures = stored(ones.join(mine.select("u"), "u", "left_semi").select("u", "signature"), "survivor-signatures")

    def collide(pairs):
        """Pairs that agree on enough coordinates."""
        both = (pairs.join(signatures.select("u", F.col("signature").alias("left")), "u")
                .join(signatures.select(F.col("u").alias("v"), F.col("signature").alias("right")), "v"))
        equal = F.aggregate(F.zip_with("left", "right", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
        return both.where(equal >= matches).select("u", "v")

    def grouped(linked):
        found = components(spark, linked.select(F.col("u").alias("a"), F.col("v").alias("b")))
        return stored(found.select(F.col("id").alias("u"), "component"), "groups")

    # every list's members against its most central one
    top = lists.groupBy("key").agg(F.max(F.struct("m", F.negative("u").alias("minus"))).alias("top"))
    pairs = lists.join(top, "key").select("u", (-F.col("top.minus")).alias("v")).where("u <> v").distinct()
    tried = stored(_confirmed(collide(pairs), texts, width, percent), "pivot-pairs")
    links = tried.where("linked").select("u", "v")
    groups = grouped(links)

    # what is left: members of one list in different groups
    held = lists.join(groups, "u", "left").select("key", "u", "n_shingles", F.coalesce("component", "u").alias("component"))
    held = stored(_open(held), "open-lists")
    # shingles that no other such document holds cannot be shared
    sets = stored(_sets(texts.join(held.select(F.col("u").alias("doc_id")).distinct(), "doc_id", "left_semi"), width, ["doc_id"])
                  .withColumnRenamed("doc_id", "u"), "open-sets")
    spread = sets.select("u", F.explode("shingles").alias("shingle"))
    shared = spread.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    most = spread.join(shared, "shingle", "left_semi").groupBy("u").agg(F.count("*").alias("most"))
    able = most.join(sets.select("u", F.size("shingles").alias("n")), "u").where(F.col("most") * 100 >= percent * F.col("n"))
    held = stored(_open(held.join(able.select("u"), "u", "left_semi")), "able-lists")
    near = stored(_compared(held, sets, percent), "near-pairs")
    more = _confirmed(near, texts, width, percent).where("linked").select("u", "v")
    return grouped(stored(links.unionAll(more), "all-links"))


def _open(lists: DataFrame) -> DataFrame:
    """Those lists whose members are in different groups."""
    keys = lists.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return lists.join(keys.where("low <> high").select("key"), "key", "left_semi")


def _compared(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): pairs of one list in different groups whose sets, by 32-bit shingle hashes, may be similar enough.

    Lists are compared inside tasks, so only such pairs become rows. A list of more than ``BLOCK`` members is cut into
    blocks that meet two at a time. A pair in several lists is looked at in the one with the smallest key.
    """
    sizes = lists.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    keys = lists.groupBy("u").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    small = sets.select("u", F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("shingles")).join(keys, "u")
    block = F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int")
    rows = lists.join(sizes, "key").select("key", "u", "component", block.alias("block"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    rows = rows.select("key", "u", "component", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    rows = rows.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)).cast("int")).join(small, "u")

    def run(table: pa.Table) -> pa.Table:
        order = table.select(["key", "i", "j"]).to_pandas().sort_values(["key", "i", "j"], kind="stable")
        cut = np.flatnonzero((order.diff() != 0).any(axis=1).to_numpy())
        index = order.index.to_numpy()
        ids, groups = (np.asarray(table.column(c)) for c in ("u", "component"))
        blocks = np.asarray(table.column("block"))
        shingles, own_keys = table.column("shingles").combine_chunks(), table.column("keys").combine_chunks()
        out = [[], []]
        for begin, end in zip(cut, np.append(cut[1:], len(index))):
            at = index[begin:end]
            key = int(order["key"].iloc[begin])
            cross = int(order["i"].iloc[begin]) != int(order["j"].iloc[begin])
            members = [np.asarray(shingles[int(k)].values) for k in at]
            before = [np.asarray(own_keys[int(k)].values) for k in at]
            before = [k[:np.searchsorted(k, key)] for k in before]
            for x, y in pairs_in_list(members, before, ids[at], groups[at], blocks[at] if cross else None, percent):
                out[0].append(ids[at[x]])
                out[1].append(ids[at[y]])
        return pa.table([pa.array(c, pa.int64()) for c in out], ["u", "v"])

    return rows.groupBy("task").applyInArrow(run, "u long, v long")


def _postings(lists: list[np.ndarray]):
    """Where each value occurs: a function from a value list to counts for each list."""
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]

    def counts(values: np.ndarray) -> np.ndarray:
        first, last = np.searchsorted(flat, values, "left"), np.searchsorted(flat, values, "right")
        size = last - first
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.bincount(owner[at], minlength=len(lists))

    return counts


def pairs_in_list(members, before, ids, groups, blocks, percent: int):
    """Pairs of members in different groups that may be similar enough and share no earlier list."""
    size = np.array([len(m) for m in members])
    overlap, earlier = _postings(members), _postings(before)
    for x in range(len(members) - 1):
        other = np.zeros(len(members), bool)
        other[x + 1:] = True
        other &= (groups != groups[x]) & (ids != ids[x])
        if blocks is not None:
            other &= blocks != blocks[x]
        other &= np.minimum(size, size[x]) * 100 >= percent * np.maximum(size, size[x]) - 200
        if not other.any():
            continue
        other &= earlier(before[x]) == 0
        if not other.any():
            continue
        shared = overlap(members[x])
        # hashes of 32 bits may merge shingles; two to spare
        for y in np.flatnonzero(other & ((shared + 2) * 100 >= percent * (size + size[x] - shared - 2))):
            yield x, int(y)
