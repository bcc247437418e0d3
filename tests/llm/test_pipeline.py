"""The registered queries, and the pipeline stage by stage against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assaylake.llm import mixing
from assaylake.llm.decontaminate import contaminated
from assaylake.llm.queries import ORACLES, QUERIES
from assaylake.llm.toxicity import toxicity
from tests.compare import connect, differences
from tests.llm.helpers import edge_docs, edge_rows, no_docs
from tests.llm.test_groups import truth
from tests.llm.test_repeats import WORD


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_beside_its_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_entry_registers_everything():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = dict(pairs(docs))
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert clean.columns == docs.columns
    rejected = {r["doc_id"] for r in toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in clean.collect()} == set(text) - rejected

    single = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    kept = {i for i, _, _, keep in truth(list(text.items()), corpus_pipeline.WIDTH, corpus_pipeline.PERCENT) if keep}
    assert {r["doc_id"] for r in single.collect()} == kept and single.columns == docs.columns

    cut = corpus_pipeline.cut_repeated_passages(spark, docs, sf)
    assert cut.schema == docs.schema or cut.dtypes == docs.dtypes
    first = {}
    words = {i: WORD.findall(t) for i, t in text.items()}
    for i, own in words.items():
        for j in range(len(own) - 49):
            key = tuple(own[j:j + 50])
            first[key] = min(first.get(key, i), i)
    for r in cut.collect():
        own, gone = words[r["doc_id"]], set()
        for j in range(len(own) - 49):
            if first[tuple(own[j:j + 50])] < r["doc_id"]:
                gone.update(range(j, j + 50))
        assert WORD.findall(r["text"]) == [w for k, w in enumerate(own) if k not in gone]
        assert r["text"] == text[r["doc_id"]] or gone

    left = corpus_pipeline.drop_contaminated(spark, docs, sf)
    leaked = {r["doc_id"] for r in contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    items = [WORD.findall(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {i for i, own in words.items() if any(f" {' '.join(it)} ".lower() in f" {' '.join(own)} ".lower() for it in items)}
    assert holds and holds <= leaked
    assert {r["doc_id"] for r in left.collect()} == set(text) - leaked

    drawn = corpus_pipeline.mix(spark, docs, sf)
    want = {r["doc_id"] for r in mixing.sampled_mix(docs).where("sampled").collect()}
    assert {r["doc_id"] for r in drawn.collect()} == want
    assert drawn.columns == [*docs.columns, "probability"]


def test_stages_on_awkward_rows(spark, sf):
    for name, stage in corpus_pipeline.STAGES:
        for docs, count in ((edge_docs(spark), len(edge_rows())), (no_docs(spark), 0)):
            out = stage(spark, docs, sf)
            if name != "mixing":
                assert out.columns == docs.columns
            assert len(out.collect()) <= count, name
    # near duplicates: rows 4 and 5 are equal, 6 comes twice, 8 and 9 differ in case only; rows without an id stay
    out = corpus_pipeline.drop_near_duplicates(spark, edge_docs(spark), sf)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, [1, 2, 3, 4, 6, None, None, 8, 10, 11, 12, 13]))
    assert corpus_pipeline.drop_toxic(spark, edge_docs(spark), sf).where(F.col("text").isNull()).count() == 2


def test_run_applies_the_stages_in_turn(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs.limit(0), sf).schema)
    assert pairs(got) == pairs(docs)
