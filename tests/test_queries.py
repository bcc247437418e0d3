"""Every registered query beside its SQL."""

import sys

import pytest

from assaylake.queries import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    assert differences(QUERIES[name](spark, sf), duck, ORACLES[name]) is None


@pytest.mark.parametrize("gone", ["assaylake.llm", "assaylake.llm.queries", "corpus_pipeline"])
def test_queries_survive_what_cannot_be_imported(monkeypatch, gone):
    import __spark_entry__

    for name in [n for n in sys.modules if n == gone or n.startswith(gone + ".")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, gone, None)
    found = __spark_entry__.queries()
    assert set(QUERIES) <= set(found) and set(ORACLES) <= set(__spark_entry__.oracle_sql()) and "pipeline" not in found
    assert gone == "corpus_pipeline" or set(QUERIES) == set(found)
