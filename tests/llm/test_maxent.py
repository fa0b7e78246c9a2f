import math
import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lastmile.llm import maxent
from lastmile.llm.maxent import lm_scores

from texts import rng, text

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]


def base(rows, train):
    """(tokens, known, all training tokens, log10 probability) by add-one counts."""
    c = Counter(w for i, t in rows if train(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]


def check(found, expected):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=repr)
    expected = sorted(expected, key=repr)
    assert [x[:4] for x in got] == [x[:4] for x in expected]
    assert np.allclose([x[4] for x in got], [x[4] for x in expected])


def corpus(n=60):
    r = rng(21)
    rows = [(i, text(r, r.choice([1, 10, 80, 400]), r.choice(["en", "fr", "de"]))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, "The  the\x0bTHE É é"), (903, "x" * 100_000)]


def test_counts_and_base_equal_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(maxent, "BLOCK_DOCS", 7)
    rows = corpus()
    found = lm_scores(documents(*rows), F.col("doc_id") % 7 != 2).collect()
    check(found, base(rows, lambda i: i % 7 != 2))
    held_out = [r for r in found if not r.train and r.n_tokens > 50]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)  # it has learnt something
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_repeated_rows_null_ids_and_no_training(spark, documents):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, "a")]
    found = lm_scores(documents(*rows), F.col("doc_id") == 1).collect()
    check(found, base(rows, lambda i: i == 1))
    assert len({r.score for r in found if r.n_tokens == 3}) == 1
    check(lm_scores(documents(*rows), F.lit(False)).collect(), base(rows, lambda i: False))
    assert lm_scores(documents(), F.lit(True)).count() == 0


def small_model(words=300, seed=1, weights=True):
    """Words 1 to ``words``, word k in group k % 40 and counted about ``1000 / k`` times."""
    r = np.random.default_rng(seed)
    vocabulary = np.arange(1, words + 1, dtype=np.uint64)
    tree = maxent.Tree.of(np.concatenate([1000.0 / vocabulary + 1, np.ones(maxent.GROUPS)]), np.concatenate([vocabulary.astype(int) % 40, np.arange(maxent.GROUPS)]))
    drawn = r.normal(size=maxent.BUCKETS).astype(np.float32) if weights else np.zeros(maxent.BUCKETS, np.float32)
    return maxent.Model(vocabulary, tree, np.zeros(maxent.GROUPS), 1, 1, drawn)


def sequence(model, hashes):
    hashes = np.array(hashes, np.uint64)
    groups = (hashes % np.uint64(40)).astype(np.uint16)
    return hashes, groups, model.leaves(hashes, groups)


def test_probabilities_of_all_leaves_sum_to_one():
    model = small_model()
    hashes, groups, leaves = sequence(model, [5, 299, 100_000, 17])
    every = np.arange(len(model.vocabulary) + maxent.GROUPS)
    total = sum(10 ** maxent.log_probabilities(model, hashes, groups, np.append(leaves[:3], leaf), np.array([0, 4]))[-1] for leaf in every)
    assert abs(total - 1) < 1e-4


def test_without_weights_leaves_have_their_shares_and_frequent_ones_short_paths():
    model = small_model(weights=False)
    mass = np.concatenate([1000.0 / model.vocabulary + 1, np.ones(maxent.GROUPS)])
    hashes, groups, leaves = sequence(model, np.arange(1, 301))
    assert np.allclose(10 ** maxent.log_probabilities(model, hashes, groups, leaves, np.array([0, 300])), (mass / mass.sum())[:300], rtol=1e-4)
    assert np.diff(model.tree.starts)[0] < np.diff(model.tree.starts)[299]


def test_a_score_equals_a_plain_walk_of_the_tree():
    model, tree = small_model(), small_model().tree
    hashes, groups, leaves = sequence(model, [5, 7, 7, 100_000, 3, 44])
    bounds, features = np.array([0, 2, 6]), maxent._features(hashes, groups, np.array([0, 2, 6]))
    expected = []
    for t, leaf in enumerate(leaves):
        p = 1.0
        for k in range(tree.starts[leaf], tree.starts[leaf + 1]):
            node, x = int(tree.nodes[k]), float(tree.bias[tree.nodes[k]])
            for f in range(4 if node >= tree.low else 1):
                key = (int(features[f, t]) ^ int(model.node_hashes[node])) * int(maxent._MIX[7]) % 2**64
                x += float(model.weights[key >> (64 - maxent.BITS)])
            p *= 1 / (1 + math.exp(-x if tree.sides[k] else x))
        expected.append(math.log10(p))
    assert np.allclose(maxent.log_probabilities(model, hashes, groups, leaves, bounds), expected, rtol=1e-4)


def test_updates_lower_the_loss():
    r = np.random.default_rng(2)
    model = small_model(weights=False)
    hashes = np.tile(np.array([3, 200, 260, 7]), 500)
    hashes[r.random(len(hashes)) < 0.1] = 9
    given, bounds = sequence(model, hashes), np.array([0, len(hashes)])
    before = maxent.log_probabilities(model, *given, bounds).sum()
    maxent.learn(model, model.weights, np.ones(maxent.BUCKETS, np.float32), *given, bounds, 0.2, 256)
    assert maxent.log_probabilities(model, *given, bounds).sum() > 0.5 * before


def test_a_sent_model_learns_the_same_with_plain_dtypes():
    model = small_model()
    sent = pickle.loads(pickle.dumps(model, 5))
    for x, kind in ((sent.weights, np.float32), (sent.tree.bias, np.float32), (sent.tree.nodes, np.int32), (sent.vocabulary, np.uint64)):
        assert x.dtype is np.dtype(kind)  # np.add.at is 30 times slower with an equal dtype that is another object
    given, bounds = sequence(model, np.arange(1, 200) % 37 + 1), np.array([0, 100, 199])
    for m in (model, sent):
        maxent.learn(m, m.weights, np.ones(maxent.BUCKETS, np.float32), *given, bounds, 0.2, 64)
    assert (model.weights == sent.weights).all()


def test_weights_are_averaged_where_they_moved():
    rows = lambda w, q: pa.record_batch([pa.array([0], pa.int32()), pa.array([np.array(w, np.float32).tobytes()]), pa.array([np.array(q, np.float16).tobytes()])], names=["chunk", "weights", "squares"])
    out = next(maxent._average((pa.scalar(0),), iter([rows([1, 5, 0], [1, 0, 0]), rows([3, 2, 0], [3, 2, 0])])))
    mean = np.frombuffer(out.column("weights")[0].as_py(), np.float32)
    assert mean[:2].tolist() == [2.5, 2.0] and np.isnan(mean[2])


def test_features_stop_at_the_start_of_a_text():
    hashes, groups = np.array([1, 2, 3, 4] * 2, np.uint64), np.array([1, 2, 3, 4] * 2, np.uint16)
    both = maxent._features(hashes, groups, np.array([0, 4, 8]))
    assert (both[:, :4] == both[:, 4:]).all()


def test_counts_beyond_32_bits_reach_the_blocks():
    most, hashes, groups = 2**31 - 1, np.array([7], np.uint64).tobytes(), np.zeros(1, np.uint16).tobytes()
    counts = np.array([most], np.int32).tobytes()
    packs = pa.table({"block": pa.array([0, 1], pa.int32()), "part": pa.array([0, 0], pa.int32()), "hashes": [hashes] * 2, "counts": [counts] * 2, "groups": [groups] * 2})
    found = maxent._count(packs).to_pylist()
    assert [np.frombuffer(r["counts"], np.int64).tolist() for r in found if r["block"] is not None] == [[2 * most]] * 2
