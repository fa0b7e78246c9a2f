import os
import re
import sys

import numpy as np
import pytest

from lastmile.llm.common import written
from lastmile.llm.queries import ORACLE_SQL, QUERIES

from texts import rng, text

import corpus_pipeline

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, documents, tmp_path):
    r = rng(41)
    item = text(r, 40)
    near = text(r, 60).split(" ")
    rows = [(i, text(r, r.choice([30, 90]), lang), lang) for i, lang in enumerate(["en", "fr", "de"] * 8)]
    rows = [(i, f"common line\n{t}", lang) for i, t, lang in rows]
    rows += [(100, " ".join(near)), (101, " ".join(near[:-1])), (102, " ".join(near)), (103, "123 !"), (104, None), (105, f"{text(r, 50)}\n{item}")]
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows


def test_stages_keep_and_drop_what_they_say(spark, tables):
    sf_dir, rows = tables
    docs, after = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = written(stage(spark, docs, sf_dir), name)
        after[name] = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == columns
    every = {i for i, *_ in rows}
    assert set(after["language_id"]) == every - {103, 104}
    assert set(after["line_dedup"]) == every - {103, 104}
    given = {i: t for i, t, *_ in rows}
    assert all(r.text == re.sub("^common line\n", "", given[i]) and r.n_chars == len(r.text) for i, r in after["line_dedup"].items())
    assert set(after["near_dedup"]) == every - {101, 102, 103, 104}
    assert set(after["decontamination"]) == every - {101, 102, 103, 104, 105}

    from tokenizers import Tokenizer

    from lastmile.llm.queries import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {}
    for p in sorted(docs.collect(), key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert ids == {i: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for i, r in after["decontamination"].items()}


def test_run_on_an_empty_table(spark, documents, tmp_path):
    documents().write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in names if re.match(r"op\d", n)}
    assert {"op7_line_dedup", "op8_license_scan", "op11_vector_code_compression", "op12_chat_formatting", "op13_ranked_lexical_search"} <= set(entry.oracle_sql()) and sys.modules["corpus_pipeline"] is corpus_pipeline


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from compare_oracle import digest, duck

    df = QUERIES[name](spark, SF_SMALL)
    found = duck(SF_SMALL).execute(ORACLE_SQL[name])
    columns, rows = [c[0] for c in found.description], found.fetchall()
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, rows)[0]
