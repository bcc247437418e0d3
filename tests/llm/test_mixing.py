"""Mixing: SQL, targets that are met, both ways of fitting, awkward rows."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaylake.llm import mixing
from tests.llm.helpers import edge_docs, edge_rows, no_docs


def test_targets_and_budget_are_met(spark):
    rows = [(i, f"s{i % 3}", "en" if i % 5 else "de", "t" if i % 2 else "u", 1 + (i * 37) % 50) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n long")
    aims = {"source": spark.createDataFrame([("s0", 0.2), ("s1", 0.3), ("s2", 0.5), ("absent", 0.4)], "value string, share double"),
            "lang": spark.createDataFrame([("en", 3.0), ("de", 1.0)], "value string, share double")}
    out = mixing.mixed(table, {n: F.col(n) for n in ("source", "lang", "topic")}, F.col("n"), {"topic": 1.0}, share=0.3, targets=aims)
    got = out.toPandas()
    got["expected"] = got["n"] * got["_mix_probability"]
    total = got["expected"].sum()
    assert len(got) == len(rows) and got["_mix_probability"].max() < 1
    assert total == pytest.approx(0.3 * got["n"].sum(), rel=1e-9)
    for name, want in (("source", {"s0": 0.2, "s1": 0.3, "s2": 0.5}), ("lang", {"en": 0.75, "de": 0.25})):
        assert (got.groupby(name)["expected"].sum() / total).to_dict() == pytest.approx(want, abs=1e-6)
    drawn = got[got["doc_id"].map(dict(out.select("doc_id", mixing.spread(F.col("doc_id"))).collect())) < got["_mix_probability"]]
    assert drawn["n"].sum() / got["n"].sum() == pytest.approx(0.3, abs=0.03)


def test_both_ways_of_fitting_agree(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    small = sorted(map(tuple, mixing.sampled_mix(table).collect()))
    monkeypatch.setattr(mixing, "SMALL_CELLS", 0)
    assert sorted(map(tuple, mixing.sampled_mix(table).collect())) == small


def test_a_factor_that_fills_some_cells():
    tokens, weight = pd.Series([10.0, 100, 1000, 0]).to_numpy(), pd.Series([0.5, 0.3, 0.2, 0.0]).to_numpy()
    got = mixing.calibrated_small(tokens, weight, 400.0)
    assert got[0] == got[1] == 1.0 and got[3] == 0.0
    assert (tokens * got).sum() == pytest.approx(400)
    assert mixing.calibrated_small(tokens, weight, 5000.0)[:3].tolist() == [1.0, 1.0, 1.0]


def test_awkward_rows(spark):
    got = mixing.sampled_mix(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert all(0 <= r["probability"] <= 1 for r in got)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in edge_rows())
    assert len({(r["sampled"], r["probability"]) for r in got if r["doc_id"] == 6 and r["source"] == "s1"}) <= 2
    assert mixing.sampled_mix(no_docs(spark)).count() == 0


def test_sql_on_awkward_rows(spark):
    con = duckdb.connect()
    documents = edge_docs(spark).select("doc_id", "text", "source", "lang").toArrow()
    con.register("documents", documents)
    want = con.execute(f"SELECT doc_id, source, lang, topic, n_tokens, probability, sampled FROM ({mixing.SQL})").fetchall()
    assert sorted(map(tuple, mixing.sampled_mix(edge_docs(spark)).collect()), key=repr) == sorted(want, key=repr)
