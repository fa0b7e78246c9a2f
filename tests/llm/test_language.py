import math

import numpy as np
import pandas as pd

from lastmile.llm.language import fitted, has_letter, identify, recognised, train

from texts import rng, text


def test_code_lengths_equal_the_tree_walk(spark, documents):
    """Bits of the flattened table against escape by escape through counted contexts."""
    texts = {"x": ["abab abac", "cab"], "y": ["bbbb acca"]}
    rows = []
    for lang, found in texts.items():
        for t in found:
            s = [0, 0, 0, *t.encode()]
            rows += [(lang, s[i] << 24 | s[i + 1] << 16 | s[i + 2] << 8 | s[i + 3], 1) for i in range(len(t))]
    model = fitted(pd.DataFrame(rows, columns=["lang", "gram", "n"]))

    def walk(lang, t):
        seen = {}
        for u in texts[lang]:
            s = "\0\0\0" + u
            for i in range(3, len(s)):
                for k in range(4):
                    seen.setdefault(s[i - k : i], {}).setdefault(s[i], 0)
                    seen[s[i - k : i]][s[i]] += 1
        bits, s = 0.0, "\0\0\0" + t
        for i in range(3, len(s)):
            for k in (3, 2, 1, 0):
                here = seen.get(s[i - k : i])
                if here:
                    total = sum(here.values()) + len(here)
                    if s[i] in here:
                        bits -= math.log2(here[s[i]] / total)
                        break
                    bits -= math.log2(len(here) / total)
            else:
                bits += math.log2(model.size)
        return bits

    for t in ("abac", "bbca", "zab cab", "c"):
        assert np.allclose(model.bits(np.frombuffer(t.encode(), np.uint8)), [walk("x", t), walk("y", t)], rtol=1e-5)


def test_held_out_accuracy_and_und(spark, documents):
    r = rng(1)
    rows = [(i, text(r, r.choice([5, 50]), lang), lang) for i, lang in enumerate(["en", "fr", "de"] * 40)]
    model = train(documents(*rows))
    assert model.languages == ["de", "en", "fr"]
    tests = [(i, text(r, 8, lang).upper() if i % 2 else text(r, 8, lang), lang) for i, lang in enumerate(["en", "fr", "de"] * 20)]
    odd = [(900, None), (901, ""), (902, "123 !?\n"), (903, "Ω"), (None, text(r, 9, "fr"), "fr")]
    found = {x.doc_id: x for x in identify(documents(*tests, *odd), model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in tests) >= 0.95 * len(tests)
    assert [(found[i].lang_pred, found[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert found[903].lang_pred in model.languages and found[None].lang_pred == "fr"
    assert all(0 <= x.score <= 1 for x in found.values())


def test_no_labels_empty_tables_and_clashing_columns(spark, documents):
    unlabelled = documents((1, "abc", None), (2, None, "en"))
    assert train(unlabelled) is None and train(documents()) is None
    assert [x.lang_pred for x in identify(unlabelled, None).collect()] == ["und", "und"]
    assert recognised(documents()).count() == 0
    model = train(documents((1, "abc def"), (2, "çéà", "fr")))
    docs = spark.createDataFrame([(1, "abc", "old", 9.0, 7)], "doc_id long, text string, lang_pred string, score double, answer int")
    (row,) = identify(docs, model).collect()
    assert (row.answer, row.lang_pred) == (7, "en") and row.score != 9.0
    assert identify(documents(), model).count() == 0


def test_pipeline_stage_keeps_what_has_a_language(spark, documents):
    rows = [(1, "the thing and", "en"), (2, "12 34", "en"), (3, None, None), (4, "le eau", None)]
    kept = recognised(documents(*rows))
    assert sorted(x.doc_id for x in kept.collect()) == [1, 4] and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_letters():
    assert [has_letter(t.encode()) for t in ("a", "1é", "中", "", "1 !", "²")] == [True, True, True, False, False, False]
