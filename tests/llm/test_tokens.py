import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lastmile.llm.tokens import HashIndex, span_hashes, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALPHABET = "abAB é\t\n\x0b 中.!"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=30)), max_size=12), st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, size):
    found = []
    for part in words(pa.array(texts, pa.string()), size):
        h = part.hashes()
        for k in range(len(part.bounds) - 1):
            spans = range(part.bounds[k], part.bounds[k + 1])
            found.append([(part.data[part.starts[i] : part.ends[i]].tobytes().decode(), int(h[i])) for i in spans])
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [[w for w, _ in x] for x in found] == expected
    names = {}
    for w, h in (p for x in found for p in x):
        assert names.setdefault(w.translate(LOWER), h) == h
    assert len(set(names.values())) == len(names)


def test_long_buffers_are_cut_between_spans(monkeypatch):
    data = np.frombuffer(b"alpha beta gamma alpha " * 50, np.uint8)
    solid = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    whole = span_hashes(data, edge[::2], edge[1::2])
    monkeypatch.setattr("lastmile.llm.tokens.SLICE_BYTES", 7)
    assert (span_hashes(data, edge[::2], edge[1::2]) == whole).all()


def test_index_finds_what_was_added():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 2**63, 50_000).astype(np.uint64))
    index = HashIndex(4)
    for lo in range(0, len(keys), 7001):
        index.add(keys[lo : lo + 7001], np.arange(lo, min(lo + 7001, len(keys)), dtype=np.int32))
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
