import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # for texts.py

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(*rows, n=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(n)

    return make
