"""Run registered queries beside their SQL in DuckDB and compare rows.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


_SAME = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


def _plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def _kind(value) -> str:
    return type(value).__name__


def differences(df, con, sql: str) -> str | None:
    """None where the rows agree exactly, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got, want = _plain(df.collect(), df.columns), _plain(result.fetchall(), names)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"{a} against {b}"
    theirs = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    for f in df.schema.fields:
        if _SAME.get(f.dataType.simpleString()) != theirs[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} against {theirs[f.name]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from assaylake.queries import ORACLES, QUERIES
    from assaylake.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            problem = differences(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        fine = problem is None or problem.startswith("rows only")
        bad += not fine
        print(f"{'ok  ' if fine else 'FAIL'} {name:28} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
