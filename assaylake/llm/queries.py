"""Registered queries of the operators, with SQL where SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import conversations, licenses, mixing, phrases, suffixes
from assaylake.llm.alignment import load_vocabularies, token_alignment
from assaylake.llm.decontaminate import contaminated
from assaylake.llm.languages import language_of
from assaylake.llm.minhash import near_duplicates
from assaylake.llm.tokencount import load_vocabulary, token_counts
from assaylake.llm.topk import top_k
from assaylake.llm.toxicity import toxicity
from assaylake.llm.urls import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mixing", mixing.SQL)
def op1(spark, sf_dir):
    return mixing.sampled_mix(table(spark, sf_dir, "documents"))


@query("op2_url_filter")
def op2(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))


@query("op3_minhash_near_dedup")
def op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def op4(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_exact_top_k")
def op5(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op6_license_scan", licenses.SQL)
def op6(spark, sf_dir):
    return licenses.license_scan(licenses.documents_as_files(table(spark, sf_dir, "documents")))


@query("op7_toxicity")
def op7(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_token_counts")
def op8(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), load_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))


@query("op9_suffix_array_dedup")
def op9(spark, sf_dir):
    return suffixes.repeat_counts(table(spark, sf_dir, "documents"))


@query("op10_substring_dedup")
def op10(spark, sf_dir):
    return phrases.repeat_counts(table(spark, sf_dir, "documents"))


@query("op11_language_id")
def op11(spark, sf_dir):
    return language_of(table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    import public_tokenizers

    models = load_vocabularies(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    return token_alignment(table(spark, sf_dir, "documents"), models)


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    return conversations.repair_audit(table(spark, sf_dir, "conversations"))
