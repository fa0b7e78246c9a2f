"""Driver contract and DuckDB oracle agreement on the smallest driver tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare_oracle import digest, duck  # noqa: E402

from lastmile.plans.queries import QUERIES  # noqa: E402


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_amount" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("missing", ["lastmile.llm", "lastmile.llm.queries", "corpus_pipeline"])
def test_the_other_queries_stay_if_an_import_of_the_optional_part_fails(monkeypatch, missing):
    import importlib

    for name in [n for n in sys.modules if n.startswith("lastmile.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # importing it raises
    try:
        again = importlib.reload(entry)
        assert set(again.queries()) == set(QUERIES) and set(again.oracle_sql()) == set(QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]
