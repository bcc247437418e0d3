"""URL verdicts: host and path rules first, then naive Bayes over segmented host and path words.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to
  ``?``, ``#`` or the end. Null urls and urls without ``://`` have an empty host and path.
* A rule fits its host and all subdomains where the path starts with the rule's; the longest rule that fits wins.
* Words: runs of a-z in a host's labels are split by the likeliest segmentation under unigram frequencies
  (Viterbi), learned from all page texts; an unknown stretch of ``n`` letters has the weight ``10 / 10**n`` of one
  occurrence. Path words are taken as they are, each run of digits is the word ``#``.
* Multinomial naive Bayes with add-one smoothing learns from every url that a rule judges and from hosts with a
  word of the seed list, which count as blocked; it judges urls without a rule. Equal odds, or training rows of
  less than two classes, mean allow.

Segmentation looks up the stretches of distinct hosts by a join, so neither the vocabulary nor the model travels
to every task. Equal urls are judged once; rows come back as often as they came in.
"""

from __future__ import annotations

import math
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.shared import stored

# executors run these helpers without this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SEEDS = ("adult", "ads", "bets", "casino", "pills", "poker", "porn", "spam", "viagra")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """The rule that wins, as struct(rule, verdict), or null. ``rules`` is configuration, compiled into the plan."""
    found = None
    for verdict, at, under in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        answer = F.struct(F.lit(at + under).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, answer) if found is None else found.when(fits, answer)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_frequencies(pages: DataFrame) -> DataFrame:
    """(word, n): words of a-z in the visible text of all pages."""
    text = F.lower(F.regexp_replace(F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " "))
    words = F.explode(F.regexp_extract_all(text, F.lit("[a-z]+"), F.lit(0)))
    return pages.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def segmented(word: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The likeliest split. ``known``: (start, length) to occurrences. Of equal splits the one with longer last words."""
    best, back = [0.0], [0]
    scale = math.log(total)
    for end in range(1, len(word) + 1):
        score, cut = -math.inf, 0
        for start in range(end):
            n = known.get((start, end - start))
            weight = math.log(n) if n else math.log(10) * (1 - (end - start))
            if best[start] + weight - scale > score:
                score, cut = best[start] + weight - scale, start
        best.append(score)
        back.append(cut)
    out, end = [], len(word)
    while end:
        out.append(word[back[end]:end])
        end = back[end]
    return out[::-1]


def _host_words(hosts: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(host, words): the words of each distinct host."""
    parts = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(r"[a-z]+|[0-9]+|[^a-z0-9.\-_]+"), F.lit(0)))
                         .alias("at", "part"))
    parts = stored(parts, "host-parts")
    longer = parts.where(F.col("part").rlike("^[a-z]{2,}$")).select("part").distinct()
    # no stretch beyond the longest word of the vocabulary can be known
    longest = F.lit(frequencies.agg(F.max(F.length("word"))).first()[0] or 1)
    stretches = longer.select("part", F.explode(F.sequence(F.lit(1), F.length("part"))).alias("start")).select(
        "part", "start", F.explode(F.sequence(F.lit(1), F.least(longest, F.length("part") - F.col("start") + 1))).alias("size"))
    stretches = stretches.withColumn("word", F.substring(F.col("part"), F.col("start"), F.col("size")))
    total = frequencies.agg(F.sum("n")).first()[0] or 1
    looked_up = stretches.join(frequencies, "word").groupBy("part").agg(
        F.collect_list(F.struct("start", "size", F.col("n").cast("double").alias("n"))).alias("known"))
    looked_up = longer.join(looked_up, "part", "left")

    def run(batches):
        for batch in batches:
            words = []
            for part, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.append(segmented(part, {(k["start"] - 1, k["size"]): k["n"] for k in known or ()}, float(total)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["part", "words"])

    split = looked_up.mapInArrow(run, "part string, words array<string>")
    single = F.array(F.when(F.col("part").rlike("^[0-9]+$"), F.lit("#")).otherwise(F.col("part")))
    words = parts.join(split, "part", "left").select("host", "at", F.coalesce("words", single).alias("words"))
    return words.groupBy("host").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))


def _path_words(path: Column) -> Column:
    words = F.regexp_extract_all(F.lower(path), F.lit(r"[a-z]+|[0-9]+|[^\x00-\x7F]+"), F.lit(0))
    return F.transform(words, lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("#")).otherwise(w))


def url_verdicts(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url, html).

    ``score`` is the log odds of a block by the words, rounded to six places, null where a rule decides.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    pairs = urls.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    pairs = stored(pairs, "urls")
    words = stored(_host_words(pairs.select("host").distinct(), stored(word_frequencies(pages), "frequencies")), "host-words")
    worded = pairs.join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    seeded = F.when(F.arrays_overlap("words", F.array(*map(F.lit, seeds))), F.lit("block"))
    worded = worded.select("host", "path", "n", "found", F.coalesce("found.verdict", seeded).alias("label"),
                           F.concat("words", _path_words(F.col("path"))).alias("words"))
    worded = stored(worded, "url-words")

    taught = worded.where("label is not null").select("label", "n", F.explode("words").alias("word"))
    block = F.sum(F.when(F.col("label") == "block", F.col("n")).otherwise(0))
    allow = F.sum(F.when(F.col("label") == "allow", F.col("n")).otherwise(0))
    model = stored(taught.groupBy("word").agg(block.alias("block"), allow.alias("allow")), "url-model")
    sums = model.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("words")).first()
    urls_of = {r["label"]: r["n"] for r in worded.where("label is not null").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(urls_of) == 2:
        prior = math.log(urls_of["block"] / urls_of["allow"])
        base = math.log(sums["allow"] + sums["words"]) - math.log(sums["block"] + sums["words"])
        odds = F.log(F.col("block") + 1) - F.log(F.col("allow") + 1) + F.lit(base)
        asked = worded.where("found is null").select("host", "path", F.explode("words").alias("word"))
        scores = asked.join(model.select("word", odds.alias("odds")), "word").groupBy("host", "path").agg(
            F.sum("odds").alias("odds"))
        score = F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 6)
    else:
        scores = worded.limit(0).select("host", "path", F.lit(0.0).alias("odds"))
        score = F.lit(0.0)
    judged = pairs.join(scores, ["host", "path"], "left").select(
        "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"),
        F.when(F.col("found").isNull(), score).alias("score"))
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return urls.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
