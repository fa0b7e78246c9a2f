import numpy as np
import pyarrow as pa

from lastmile.llm import toxicity as T
from lastmile.llm.tokens import words

from texts import rng, text

BAD = ["idiot", "moron", "clown"]


def labelled(r, n, lang="en"):
    rows = []
    for i in range(n):
        t = text(r, r.choice([10, 40, 150]), lang).split(" ")
        bad = i % 3 == 0
        if bad:
            for _ in range(1 + len(t) // 20):
                t.insert(r.randrange(len(t)), r.choice(BAD))
        rows.append((i, " ".join(t), int(bad)))
    return rows


def frame(spark, rows, kind="doc_id long, text string, toxic int"):
    return spark.createDataFrame(rows, kind).repartition(3)


def test_gradients_equal_differences():
    r = np.random.default_rng(1)
    net = T.new_network(np.zeros(0, np.uint64))
    net.weights = {k: v.astype(np.float64) * (30 if k == "grams" else 2) for k, v in net.weights.items() if k != "words"}
    rows = r.normal(size=(6, T.WORD_SIZE + T.GRAM_SIZE))
    places, mask = r.integers(0, 5, (3, T.WINDOW)), np.ones((3, T.WINDOW))
    mask[1, 7:] = 0
    slope = r.normal(size=3)
    loss = lambda: float((net.forward(rows, places, mask) * slope).sum())
    kept = []
    net.forward(rows, places, mask, kept)
    found, d_rows = net.backward(rows, places, mask, kept, slope)
    for name, array, gradient in [*((k, net.weights[k], g) for k, g in found.items()), ("rows", rows, d_rows)]:
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in array.shape)
            old = array[at]
            array[at] = old + 1e-5
            up = loss()
            array[at] = old - 1e-5
            down = loss()
            array[at] = old
            assert np.isclose((up - down) / 2e-5, gradient[at], rtol=1e-4, atol=1e-7), name


def test_windows_overlap_and_cover_all():
    for n in (0, 1, T.WINDOW, T.WINDOW + 1, 5 * T.WINDOW + 3):
        text_, start, length = T.windows(np.array([0, 4, 4 + n]))
        own = [(s - 4, k) for t, s, k in zip(text_, start, length) if t == 1]
        assert {p for s, k in own for p in range(s, s + k)} == set(range(n))
        assert all(b - a <= T.STRIDE for (a, _), (b, _) in zip(own, own[1:]))


def test_trigrams_stop_at_words():
    x = T.inputs(next(words(pa.array(["ab cd ab", "b"]))))
    by = {int(h): x.grams[a:b].tolist() for h, a, b in zip(x.hashes, x.bounds, [*x.bounds[1:], len(x.grams)])}
    y = T.inputs(next(words(pa.array(["ab"]))))
    assert len(x.hashes) == 3 and by[int(y.hashes[0])] == y.grams.tolist() and sorted(map(len, by.values())) == [1, 2, 2]


def test_held_out_accuracy_and_defined_results(spark):
    r = rng(31)
    net = T.train(frame(spark, labelled(r, 240)))
    tests = labelled(r, 90) + [(900, None, 0), (901, "", 0), (902, " \n", 0), (903, "idiot", 1), (None, "a moron and a clown", 1)]
    found = {x.doc_id: x for x in T.score(frame(spark, tests), net).collect()}
    right = sum((found[i].score >= 0.7) == bool(y) for i, _, y in tests[:90])
    assert right >= 80
    assert len({found[i].score for i in (900, 901, 902)}) == 1 and found[900].score < 0.3
    assert all(0 <= x.score <= 1 for x in found.values())


def test_no_labels_one_label_and_clashing_columns(spark):
    assert T.train(frame(spark, [])) == 0.0 and T.train(frame(spark, [(1, "a", None)])) == 0.0
    assert T.train(frame(spark, [(1, "a", 1), (2, None, 1)])) == 1.0
    docs = frame(spark, [(1, "a", 5.0, 3)], "doc_id long, text string, score double, name int")
    (row,) = T.score(docs, 0.25).collect()
    assert (row.score, row.name) == (0.25, 3)
    assert T.score(frame(spark, []), 0.0).count() == 0


def test_every_window_of_the_sampled_texts_is_trained_and_scales(spark, monkeypatch):
    r = rng(32)
    rows = [(i, " ".join(text(r, n).split()), i % 2) for i, n in enumerate((5, 30, 700, 2000, 1200, 1500))]
    met = []
    monkeypatch.setattr(T, "fit", lambda texts, group, label, clean: met.append((texts, group, label)) or T.new_network(np.zeros(0, np.uint64)))
    T.train(frame(spark, rows))
    (texts, group, label), = met
    expected = []
    for _, t, y in rows:
        w = t.split()
        expected += [(" ".join(w[a : a + n]), y) for a, n in zip(*T.windows(np.array([0, len(w)]))[1:])]
    assert sorted(zip(texts, label.astype(int).tolist())) == sorted(expected) and len(np.unique(group)) == len(rows)
