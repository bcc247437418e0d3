"""License scan: SQL, inheritance by nearest directory, native plans."""

import duckdb

from assaylake.llm import licenses
from assaylake.llm.licenses import documents_as_files, license_scan
from tests.llm.helpers import edge_docs, edge_rows, no_docs

FILES = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
    (3, "a/b/c/x.txt", "nothing here"),
    (4, "a/d/y.txt", None),
    (5, "z.txt", "plain"),
    (6, "a/b/own.txt", "code " * 40 + "\nThis work is licensed under the GNU General Public License, version 3.\n" + "code " * 400),
    (7, "a/b2/w.txt", "my warranty void"),
    (8, None, ""),
    (8, None, ""),
    (9, "a/b/LICENSE.txt", "Released under the MIT License."),
]


def files(spark, rows):
    return spark.createDataFrame([(i, p, t, "x") for i, p, t in rows], "doc_id long, path string, text string, score string")


def test_inheritance(spark):
    got = license_scan(files(spark, FILES)).collect()
    out = {r["doc_id"]: (r["own_license"], r["license"], r["origin"]) for r in got}
    assert len(got) == len(FILES)
    assert out[1] == ("MIT", "MIT", "a/LICENSE")
    assert out[3] == (None, "Apache-2.0", "a/b") or out[3] == (None, "MIT", "a/b")
    assert out[4] == (None, "MIT", "a") and out[5] == (None, None, None) and out[8] == (None, None, None)
    assert out[6] == ("GPL-3.0", "GPL-3.0", "a/b/own.txt")
    assert out[7] == (None, "MIT", "a")
    assert license_scan(files(spark, [])).count() == 0


def test_awkward_rows_beside_sql(spark):
    con = duckdb.connect()
    table = edge_docs(spark)
    con.register("documents", table.select("doc_id", "text", "source", "lang").toArrow())
    columns = "doc_id, path, own_license, score, license, origin"
    want = con.execute(f"SELECT {columns} FROM ({licenses.SQL})").fetchall()
    got = license_scan(documents_as_files(table)).select(*columns.split(", ")).collect()
    assert len(got) == len(edge_rows())
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert license_scan(documents_as_files(no_docs(spark))).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = license_scan(documents_as_files(spark.read.parquet(f"{sf}/documents.parquet")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
