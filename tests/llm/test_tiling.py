import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lastmile.llm import tiling
from lastmile.llm.tiling import decontaminated, overlaps, tile

from texts import rng, text


def brute_tiles(item, doc, least):
    """Greedy string tiling as it is defined: at each turn the longest unmarked common string."""
    a, b = [True] * len(item), [True] * len(doc)
    lengths = []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and a[i + k] and b[j + k] and item[i + k] == doc[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return sorted(lengths, reverse=True)
        lengths.append(k)
        a[i : i + k], b[j : j + k] = [False] * k, [False] * k


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 4), max_size=25), st.integers(1, 4))
def test_tiles_equal_the_definition(item, doc, least):
    found = tile(np.array(item, np.uint64), np.array(doc, np.uint64), least)
    for i, j, k in found:
        assert item[i : i + k] == doc[j : j + k]
    assert sum(len(set(range(i, i + k))) for i, _, k in found) == len({p for i, _, k in found for p in range(i, i + k)})
    assert sum(len(range(j, j + k)) for _, j, k in found) == len({p for _, j, k in found for p in range(j, j + k)})
    expected = brute_tiles(item, doc, least)
    if len(set(item)) == len(item) and len(set(doc)) == len(doc):  # no ties
        assert sorted((k for _, _, k in found), reverse=True) == expected
    elif expected:
        assert max(k for _, _, k in found) == expected[0]


def test_long_copies_take_seconds_and_shuffled_pieces_come_back():
    r = np.random.default_rng(3)
    item = r.integers(1, 2**63, 20_000).astype(np.uint64)
    began = time.monotonic()
    assert tile(item, np.concatenate([item[:7], item, item[9:50]])) == [(0, 7, 20_000)]
    cuts = np.sort(r.choice(np.arange(5, 19_995), 60, replace=False))
    pieces = [p for p in np.split(item, cuts) if len(p) >= 3]
    shuffled = np.concatenate([x for k in r.permutation(len(pieces)) for x in (pieces[k], r.integers(1, 2**63, 2).astype(np.uint64))])
    found = tile(item, shuffled)
    assert sum(k for _, _, k in found) == sum(map(len, pieces))
    for i, j, k in found:
        assert (item[i : i + k] == shuffled[j : j + k]).all()
    same = np.full(5000, 7, np.uint64)
    assert tile(same, np.full(20_000, 7, np.uint64)) == [(0, 0, 5000)]
    assert time.monotonic() - began < 20


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_whole_reordered_and_partial_passages(spark, documents):
    r = rng(8)
    item = text(r, 40, line=10)
    lines = item.split("\n")
    other = text(r, 200)
    rows = [(1, f"{other}\n{item.upper()}!"), (2, "\n".join([lines[2], other, lines[0], lines[3], "x", lines[1]])), (3, other), (4, lines[0]), (5, None), (6, "")]
    rows += [(7, item), (7, item), (None, item)]
    bench = items(spark, (10, item), (11, None), (12, "..."), (13, "short one"), (10, item))
    found = overlaps(documents(*rows), bench, min_coverage=0.5).collect()
    assert sorted((x.doc_id if x.doc_id is not None else -1, x.n_tiles) for x in found) == sorted([(1, 1), (2, 4), (7, 1), (7, 1), (-1, 1)] * 2)
    assert all(x.coverage == 1.0 and x.item_id == 10 for x in found)
    kept = decontaminated(documents(*rows), bench)
    assert sorted(x.doc_id for x in kept.collect()) == [3, 4, 5, 6] and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_items_shorter_than_a_seed_match_whole(spark, documents):
    found = overlaps(documents((1, "say the short one now"), (2, "short"), (3, "one short")), items(spark, (5, "Short ONE")))
    assert [(x.doc_id, x.covered) for x in found.collect()] == [(1, 2)]


def test_blocks_of_the_benchmark_meet_every_document(spark, documents):
    r = rng(11)
    bench = [(i, text(r, 20)) for i in range(9)]
    docs = documents(*[(i, f"{text(r, 50)}\n{t}") for i, t in bench])
    for block in (1, 300, 1 << 20):
        found = overlaps(docs, items(spark, *bench), block_bytes=block).collect()
        assert sorted((x.doc_id, x.item_id) for x in found) == [(i, i) for i, _ in bench]


def test_empty_tables(spark, documents):
    assert overlaps(documents((1, "a")), items(spark)).count() == 0
    assert overlaps(documents(), items(spark, (1, "a b c d e f"))).count() == 0


def test_runs_as_short_as_a_tile_are_found(spark, documents):
    words = text(rng(17), 40).split()
    swapped = "one two three four five six"
    changed = " ".join("x" if k % 4 == 3 else w for k, w in enumerate(words))
    found = overlaps(documents((1, changed), (2, "four five six, one two three"), (3, "one two, three")), items(spark, (5, " ".join(words)), (6, swapped)))
    assert sorted((x.doc_id, x.item_id, x.coverage) for x in found.collect()) == [(1, 5, 0.75), (2, 6, 1.0), (3, 6, 0.5)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=12), min_size=1, max_size=4), st.lists(st.lists(st.integers(1, 6), max_size=20), min_size=1, max_size=4), st.sampled_from([1, 1 << 20]))
def test_candidates_leave_out_no_covered_item(own, docs, held):
    arrays = [np.array(x, np.uint64) for x in own]
    seeds = tiling.Seeds(list(range(len(own))), arrays)
    before, tiling.HELD = tiling.HELD, held
    try:
        found = list(seeds.candidates(np.array(sum(docs, []), np.uint64), np.cumsum([0, *map(len, docs)]), 0.5))
    finally:
        tiling.HELD = before
    covered = lambda a, d: sum(k for _, _, k in tile(a, np.array(d, np.uint64), min(3, len(a))))
    assert len(found) == len(set(found))
    assert {(i, k) for i, d in enumerate(docs) for k, a in enumerate(arrays) if covered(a, d) >= 0.5 * len(a)} <= set(found)
