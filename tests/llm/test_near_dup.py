import re
from itertools import combinations

import numpy as np

from lastmile.llm.components import components
from lastmile.llm import near_dup
from lastmile.llm.near_dup import deduplicated, near_duplicates, parities, shingles, signatures

from texts import rng, text, word

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Components of rows with distinct ids."""
    sets = {i: sets_of(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((find(a), find(b)))
            label[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(r):
    """Exact copies, near copies, chains of them, shared passages, short and empty texts."""
    rows, passage = [], text(r, 60)
    for _ in range(12):
        base = text(r, r.choice([8, 40, 120])).split(" ")
        for copy in range(r.choice([1, 2, 6])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2])):
                words[r.randrange(len(words))] = word(r)
            base = words if r.random() < 0.5 else base  # a chain, whose ends are far apart
            rows.append(" ".join(words))
    rows += [f"{passage} {text(r, n)}" for n in (5, 10, 20, 40, 80, 5, 10)] + ["A b", "a  B", "a b c d e", "A B C D E", "", None, "  \n", "x"] * 2
    order = list(range(len(rows)))
    r.shuffle(order)
    return [(10 * i + 3, rows[k]) for i, k in enumerate(order)]


def test_equals_all_pairs(spark, documents):
    rows = corpus(rng(1))
    found = near_duplicates(documents(*rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows)
    assert len(found) == len(rows)


def test_a_large_group_of_near_copies(spark, documents):
    r = rng(4)
    base = text(r, 100).split(" ")
    rows = []
    for i in range(400):
        words = list(base)
        words[r.randrange(len(words))] = word(r)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, text(r, 30)) for i in range(20)]
    found = near_duplicates(documents(*rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows)


def test_repeated_and_null_ids(spark, documents):
    long = text(rng(6), 30)
    rows = [(2, long), (2, long), (5, long), (None, long), (2, "another text of its own here"), (None, "lonely"), (None, None), (8, None), (8, None)]
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(*rows)).collect()), key=repr)
    assert found == sorted(
        [(2, 2, True)] * 3 + [(5, 2, False), (None, 2, False), (None, None, True), (None, None, True), (8, 8, True), (8, 8, True)], key=repr
    )
    kept = sorted(((r.doc_id, r.text) for r in deduplicated(documents(*rows)).collect()), key=repr)
    assert kept == sorted([(2, long), (2, "another text of its own here"), (None, "lonely"), (None, None), (8, None)], key=repr)


def test_repeated_rows_are_one_class_in_the_buckets(spark, documents, monkeypatch):
    sizes, real = {}, near_dup.written

    def counted(df, name):
        out = real(df, name)
        sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    base = text(rng(7), 60).split(" ")
    near = [" ".join([*base[:20], "other", *base[21:]]), " ".join([*base[:50], "word", *base[51:]])]
    rows = [(1, " ".join(base))] * 2000 + [(2, near[0]), (3, near[1])]
    found = near_duplicates(documents(*rows)).collect()
    assert len(found) == 2002 and {r.component_id for r in found} == {1}
    assert sizes["buckets"] <= 3 * near_dup.BANDS


def test_deduplicated_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "y"), (3, "c", None)], "doc_id long, text string, kept_id string").withColumnRenamed("kept_id", "own_hash")
    assert sorted(map(tuple, deduplicated(docs).collect())) == [(1, "a b", "x"), (3, "c", None)]


def test_empty_table_and_no_words(spark, documents):
    assert near_duplicates(documents()).count() == 0
    assert [tuple(r)[:4] for r in near_duplicates(documents((4, " "))).collect()] == [(4, 0, 4, True)]


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 501 + i) for i in range(50)] + [(7, 7), (901, 900), (900, 901), (-5, 139)]
    label = {i: i for i, j in links} | {j: j for i, j in links if i != j}
    for _ in range(200):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    label.pop(7)
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.label for r in found.collect()} == label


def test_signature_recall_at_the_threshold():
    """Sets of similarity 0.75 share a bucket nearly always, unrelated ones nearly never."""
    r = np.random.default_rng(3)
    shared = apart = 0
    for _ in range(300):
        x = r.integers(0, 2**63, 200).astype(np.uint64)
        y = np.concatenate([x[:171], r.integers(0, 2**63, 29).astype(np.uint64)])  # 171 / 229
        z = r.integers(0, 2**63, 200).astype(np.uint64)
        a, b, c = signatures(np.concatenate([x, y, z]), np.array([0, 200, 400]))
        shared += bool((a == b).any())
        apart += bool((a == c).any())
    assert shared == 300 and apart == 0


def test_shingles_are_distinct_and_bounded():
    found, at = shingles(np.array([1, 1, 1, 1, 1, 1, 1, 2, 3], np.uint64), np.array([0, 7, 7, 9]))
    assert at.tolist() == [0, 1, 1, 2] and len(found) == 2


def test_parities_bound_the_difference():
    r = np.random.default_rng(5)
    for n, k in ((30, 10), (300, 100), (5000, 2000)):
        x = r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        y = np.concatenate([x[k:], r.integers(0, 2**63, k).astype(np.uint64)])
        a, b = parities(np.concatenate([x, y]), np.array([0, n])).view(np.uint64)
        differ = sum(bin(int(v)).count("1") for v in a ^ b)
        assert 0 < differ <= 2 * k
