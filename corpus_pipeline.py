"""From raw documents to a training mix: toxicity, near and substring dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one works on what it kept, written as
Parquet and read again. All but the last return the columns of documents. Rows without ``doc_id`` and with null or empty texts pass
every stage but the last, which draws by probability; extra columns are carried along.

SQL cannot express the classifier, the signatures and the alignments, so there is no ``ORACLE_SQL``; the tests hold
every stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import mixing, phrases, toxicity
from assaylake.llm.decontaminate import contaminated
from assaylake.llm.minhash import near_duplicates
from assaylake.llm.shared import stored

ORACLE_SQL = None

WIDTH, PERCENT = 5, 80  # words of a shingle and least similarity, in hundredths, of near duplicates
MATCHES = 17  # of 40 coordinates; a pair at the least similarity has fewer with a chance of about 4e-8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels outside the fold held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, toxicity.third(F.col("doc_id")) != 1)
    return toxicity.scored(docs, model, "_toxicity_score").where(F.col("_toxicity_score") < toxicity.THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; of a repeated row one."""
    kept = near_duplicates(docs, width=WIDTH, percent=PERCENT, matches=MATCHES).where("kept and doc_id is not null")
    named = docs.where("doc_id is not null").join(kept.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "doc_id", "left_semi")
    # equal ids share a partition after the join, so this shuffles nothing
    named = named.withColumn("_near_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_near_text"]).drop("_near_text")
    return named.unionByName(docs.where("doc_id is null")).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words and more that a document with a smaller id holds too."""
    cut = phrases.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an exact or edited copy of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = F.xxhash64("doc_id", "text")  # tells rows apart where ids are null
    found = stored(contaminated(docs.select(key.alias("doc_id"), "text"), benchmark), "contaminated")
    return docs.withColumn("_leak_key", key).join(found.select(F.col("doc_id").alias("_leak_key")), "_leak_key", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics get their weights, with their ``probability``.

    A column of that name is replaced.
    """
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    weighted = mixing.mixed(docs, dimensions, mixing.tokens_of(F.col("text")), mixing.POWERS, share=mixing.SHARE)
    drawn = weighted.where(mixing.spread(F.col("doc_id")) < F.col("_mix_probability"))
    return drawn.select(*[c for c in docs.columns if c != "probability"], F.round("_mix_probability", 6).alias("probability"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
