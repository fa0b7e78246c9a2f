import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastmile.llm import vector_codes
from lastmile.llm.vector_codes import bound, compressed, distinct, encode, integers, nearest, train

from texts import rng

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain Python over (id, vector, label)."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = min(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(first[1])]
    size = -(-len(first[1]) // parts)
    cut = lambda v: [tuple((v + [0] * (size * parts - len(v)))[p * size : (p + 1) * size]) for p in range(parts)]
    by_id = {}
    for i, v, _ in kept:
        key = (i is None, i or 0)
        by_id[key] = min(by_id.get(key, v), v)
    books = [[cut(by_id[k])[p] for k in sorted(by_id)[:entries]] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                x = cut(v)[p]
                groups.setdefault(near(p, x)[1], []).append(x)
            new = list(books[p])
            for e, xs in groups.items():
                new[e] = tuple(sum(c) // len(xs) for c in zip(*xs))
            books[p] = new
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        found = [near(p, x) for p, x in enumerate(cut(v))]
        coded.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, error, label in coded:
        total[label] = total.get(label, 0) + error
    return sorted(((i, code, error, total[label], digest) for i, code, error, label in coded), key=str)


def found(spark, rows, n=3, **kw):
    df = compressed(spark.createDataFrame(rows, SCHEMA).repartition(n), **kw)
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def vectors(r, n, dims=8, spread=0.05):
    return [(i, [round(r.gauss(0, spread), 3) for _ in range(dims)], r.choice([0, 1, None])) for i in range(n)]


def test_equals_brute_force_with_copies_and_unusable_rows(spark):
    r = rng(4)
    rows = vectors(r, 150)
    rows += [(200 + i, rows[7][1], 5) for i in range(80)]  # a large group of copies
    rows += [(300, None, 1), (301, [1.0, None] * 4, 1), (302, [float("nan")] * 8, 1), (303, [float("inf")] * 8, 1), (304, [], 1), (305, [0.5] * 3, 1)]
    rows += [(7, rows[9][1], 0), (7, rows[9][1], 0), (None, rows[3][1], 2)]
    for entries, n in ((16, 3), (256, 7)):
        assert found(spark, rows, n, entries=entries) == brute(rows, entries=entries)


def test_lengths_that_cant_be_cut_evenly_and_few_vectors(spark):
    r = rng(6)
    assert found(spark, vectors(r, 20, 6), entries=4) == brute(vectors(rng(6), 20, 6), entries=4)
    assert found(spark, [(1, [0.5, -0.5, 0.1, 9.0], 0)]) == brute([(1, [0.5, -0.5, 0.1, 9.0], 0)])
    assert [x[1:4] for x in found(spark, [(1, [], 0), (2, [], 0)])] == [("00000000", 0, 0)] * 2
    assert found(spark, []) == [] and found(spark, [(1, None, 0)]) == []


def test_huge_components_stay_within_the_bound(spark):
    rows = [(1, [3e38] * 8, 0), (2, [-3e38] * 8, 0), (3, [0.0] * 8, 0)]
    got = found(spark, rows, entries=1)
    b = bound(8)
    assert [x[2] for x in got] == [b * b * 8, b * b * 8, 0]
    assert 8 * (2 * b) ** 2 <= 2**62


@pytest.mark.parametrize("leaves", [1, 3, 50])
def test_the_trie_gives_the_nearest_entry(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    r = np.random.default_rng(leaves)
    for spread, dims in ((2, 5), (40, 3), (2**27, 4)):
        rows, centres = r.integers(-spread, spread, (300, dims)), r.integers(-spread, spread, (20, dims))
        kinds, place, copies = distinct(rows)
        assert (kinds[place] == rows).all() and copies.sum() == 300 and [tuple(x) for x in kinds] == sorted(set(map(tuple, rows.tolist())))
        entry, far = nearest(kinds, centres)
        every = ((kinds[:, None, :] - centres[None]) ** 2).sum(2)
        assert (entry == every.argmin(1)).all() and (far == every.min(1)).all()


def test_blocks_cut_long_batches(spark, monkeypatch):
    rows = vectors(rng(8), 60)
    want = brute(rows, entries=8)
    import pyarrow as pa

    sizes = [(length, len(kept)) for length, kept, _ in integers(pa.array([v for _, v, _ in rows] + [[0.1]], pa.list_(pa.float32())), 1024)]
    assert sizes == [(1, 1), (8, 60)]
    assert found(spark, rows, 1, entries=8) == want


def test_other_columns_stay_and_clashing_names_are_replaced(spark):
    df = spark.createDataFrame(vectors(rng(2), 30), SCHEMA).withColumns({"code": F.lit(1), "Error": F.lit("x"), "part": F.lit(2), "n": F.lit("y")})
    out = encode(df, train(df, entries=4))
    assert out.columns == ["vec_id", "label", "part", "n", "code", "error"] and out.count() == 30
    assert {r["n"] for r in out.collect()} == {"y"}
    assert compressed(df.withColumns({"of_label": F.lit(1), "label_error": F.lit(0)}), entries=4).count() == 30


def test_entries_fit_two_digits(spark):
    with pytest.raises(ValueError, match="256"):
        train(spark.createDataFrame([], SCHEMA), entries=300)
