import copy
import math
import re
from collections import Counter

import numpy as np
import pytest

from lastmile.llm import lexical
from lastmile.llm.lexical import Best, Items, Tree, Weighted, lexical_search, search_tree, terms_of

from texts import rng, text

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    out = []
    for item, t in items:
        rows = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for term in terms(t):
                df = sum(term in c2 for _, c2, _ in held)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i))
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank, r[2], -r[0]) for rank, r in enumerate(rows[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_equals_brute_force_with_copies_and_ties(spark, documents, monkeypatch):
    monkeypatch.setattr(lexical, "TREE", 600)  # several trees a task
    monkeypatch.setattr(lexical, "LEAF", 3)
    r = rng(11)
    rows = [(i, text(r, r.choice([1, 5, 30, 120]), r.choice(["en", "fr", "de"]))) for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [(900, None), (901, ""), (902, "!?"), (903, "É é ÀB")]
    items = [(j, text(rng(j), 25, lang)) for j, lang in enumerate(["en", "fr", "de"])] + [(7, rows[3][1]), (8, "É the THE the"), (9, "..."), (10, None)]
    assert found(lexical_search(documents(*rows, n=4), items_of(spark, *items))) == brute(rows, items)
    assert found(lexical_search(documents(*rows, n=2), items_of(spark, *items), k=3)) == brute(rows, items, 3)
    # every item in a block of its own
    assert found(lexical_search(documents(*rows), items_of(spark, *items[:2]), block_bytes=1)) == brute(rows, items[:2])


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "alpha beta", 1), (1, "alpha beta", 2), (None, "alpha beta", 3), (2, "alpha", 4), (3, "gamma", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long").withColumn("rank", docs_col())
    docs = docs.withColumn("item_id", docs_col()).withColumn("n", docs_col()).withColumn("terms", docs_col())
    items = [(4, "beta alpha"), (4, "beta alpha"), (4, "gamma")]
    got = found(lexical_search(docs, items_of(spark, *items)))
    assert got == brute([(i, t) for i, t, _ in rows], [(4, "beta alpha"), (4, "gamma")])
    assert [x[2] for x in got if x[3] == got[0][3]] == [1, 1, None]


def docs_col():
    from pyspark.sql import functions as F

    return F.lit(0)


def test_empty_tables(spark, documents):
    none = documents()
    assert found(lexical_search(none, items_of(spark, (1, "a b")))) == []
    assert found(lexical_search(documents((1, "a")), items_of(spark))) == []
    assert lexical_search(none, items_of(spark)).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_a_long_text_in_pieces_has_the_terms_of_the_pattern(monkeypatch, size):
    monkeypatch.setattr(lexical, "PIECE", size)
    long = text(rng(3), 4000) + " " + "x" * 300 + " Ünï\xa0cØde A1_b2-C3\x00d"
    assert [t.decode() for p in terms_of(long.encode()) for t in p] == terms(long)


def test_bounds_prune_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", 2)
    r = rng(5)
    vocabulary = [f"w{x}" for x in range(300)]
    docs = [(i, [vocabulary[min(int(r.expovariate(0.02)), 299)] for _ in range(40)]) for i in range(3000)]
    docs += [(9000 + i, docs[5][1]) for i in range(500)]
    items = Items()
    for j in range(12):
        items.add(j, " ".join(docs[j][1][:20]).encode())
    number = items.vocabulary
    vectors = [Counter(number[w.encode()] for w in d if w.encode() in number) for _, d in docs]
    df = np.bincount([t for v in vectors for t in v], minlength=len(number))
    by = Weighted(items, len(docs), 40 * len(docs), df)
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    flat = [(t, n) for v in vectors for t, n in v.items()]
    tree = Tree([i for i, _ in docs], [40] * len(docs), bounds, np.array([t for t, _ in flat]), np.array([n for _, n in flat]), by, 10)
    assert len(tree.ids) <= 3000 and sum(map(len, tree.ids)) < len(docs)  # copies are one entry
    best = Best(12, 10)
    first = search_tree(tree, by, best)
    assert search_tree(tree, by, Best(12, 10)) == first
    again = search_tree(tree, by, copy.deepcopy(best))  # with final thresholds little is scored
    assert again < first < 12 * len(tree.ids) and again < 12 * len(tree.ids) / 2
    got = sorted((j, rank, r[2], -r[0]) for j, rows in enumerate(best.found) for rank, r in enumerate(rows, 1))
    want = brute([(i, " ".join(d)) for i, d in docs], [])
    assert want == [] and len(got) == 120
    for j in range(12):
        scores = sorted(((-sum(by_score(by, items, j, t, n, 40) for t, n in v.items()), i) for (i, _), v in zip(docs, vectors)))[:10]
        assert [(r[0], r[2]) for r in best.found[j]] == scores


def by_score(by, items, j, t, n, size):
    at = range(by.first[by.rank[t]], by.first[by.rank[t] + 1])
    return sum(int(by.weight[x]) for x in at if by.owner[x] == j) * ((10**9 * n) // (1000 * n + 8 * by.m(size)))


def test_sums_beyond_doubles_are_exact(spark, documents):
    items = Items()
    items.add(1, b"a " * 3 + b"b")
    by = Weighted(items, 5, 20, np.array([2, 1]))
    tree = lambda: Tree([1, 2], [4, 4], np.array([0, 2, 3]), np.array([0, 1, 0]), np.array([3, 1, 2]), by, 10)
    in_doubles, exact = Best(1, 10), Best(1, 10)
    assert by.in_doubles
    search_tree(tree(), by, in_doubles)
    by.in_doubles = False
    search_tree(tree(), by, exact)
    assert in_doubles.found == exact.found and len(exact.found[0]) == 2
