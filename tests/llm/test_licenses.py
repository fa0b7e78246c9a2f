import pytest

from lastmile.llm.licenses import TEMPLATES, anchors, bigrams, needed, normalised_words, scan_licenses


def brute(rows, templates, threshold):
    """Every window that begins with a bigram of the template, without any pruning."""
    out = []
    for i, text in rows:
        words = normalised_words(text or "")
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        for name, template in templates.items():
            wanted = normalised_words(template)
            found, span = set(bigrams(wanted)), len(wanted) - 1
            best = (0.0, 0, 0)
            for start in range(len(pairs)):
                own = set(pairs[start : start + span])
                if pairs[start] in found:
                    dice = 2 * len(own & found) / (len(own) + len(found))
                    if dice > best[0]:
                        best = (dice, start, min(span, len(pairs) - start) + 1)
            if best[0] >= threshold:
                out.append((i, name, best[1], best[2], best[0]))
    return sorted(out, key=repr)


def run(docs, **kw):
    return sorted((tuple(r) for r in scan_licenses(docs, **kw).collect()), key=repr)


APACHE = TEMPLATES["Apache-2.0-header"].split(" ")
ROWS = [
    (1, "some text\nReleased under the MIT License.\nmore"),
    (2, "RELEASED!! UNDER!! THE!! MIT!! LICENSE\nLicensed under the Apache License, Version 2.0."),
    (3, "This work is licensed under the GNU General Public License (version 3)\nthe license of the text under review"),
    (4, None), (5, ""), (6, "license"), (7, "All rights reserved."), (7, "All rights reserved."), (None, "all  rights\treserved"),
    (8, TEMPLATES["MIT-header"]), (9, "This licence is licensed under " * 2000 + "the MIT License"), (10, "É under the MIT License released"),
    (11, "This file is released under the MIT License. See the LICENSE file for details; all rights are reserved to nobody."),
    (12, "# " + "\n# ".join(" ".join(APACHE[k : k + 11]) for k in range(0, len(APACHE), 11)) + "\nimport os"),
    (13, "x " * 30000 + TEMPLATES["MIT-text"].replace("the ", "THE\n") + " y" * 30000),
    (14, TEMPLATES["BSD-3-Clause-text"].replace("the copyright holder", "Example Limited").replace("software", "program")),
    (15, "released under the released under the mit license the mit license released under the"),
    (16, "the software is provided to those who work under a contract with a version of the source " * 50),
    (17, "Licensed under CC BY-SA 4.0 and licensed under CC BY-NC 4.0"), (18, "under the MIT License"),
]


@pytest.mark.parametrize("threshold", [0.5, 0.75, 1.0])
def test_equals_brute_force(spark, documents, threshold):
    found = run(documents(*ROWS), threshold=threshold)
    assert found == brute(ROWS, TEMPLATES, threshold)
    if threshold == 0.75:
        assert {(i, name) for i, name, *_ in found} >= {(11, "MIT"), (12, "Apache-2.0-header"), (13, "MIT-text"), (13, "MIT-header"), (14, "BSD-3-Clause-text"), (17, "CC-BY-SA-4.0"), (18, "MIT")}


def test_every_template_is_found_as_itself(spark, documents):
    names = sorted(TEMPLATES)
    found = run(documents(*[(i, "before it " + TEMPLATES[n] + "\nafter it") for i, n in enumerate(names)]))
    assert {(i, name) for i, name, _, _, dice in found if dice == 1.0 and name == names[i]} == set(enumerate(names))


def test_anchors_touch_what_a_match_needs():
    known = {name: bigrams(normalised_words(t)) for name, t in TEMPLATES.items()}
    for threshold in (0.3, 0.75, 1.0):
        chosen = set(anchors(known, threshold))
        for found in known.values():
            assert sum(not chosen & set(pair.split(" ")) for pair in found) < needed(found, threshold)


def test_empty_table_templates_clashing_columns_and_plan(spark, documents):
    assert run(documents()) == [] and run(documents((1, "MIT License")), templates={}) == [] and run(documents((1, "a b")), templates={"x": "one"}) == []
    assert run(documents((1, "odd one here")), templates={"b": "odd one here", "a": "odd one here"}) == [(1, "a", 0, 3, 1.0), (1, "b", 0, 3, 1.0)]
    clash = spark.createDataFrame([(1, "All rights reserved.", "x", 3, "y")], "doc_id long, text string, license string, pairs int, id string")
    assert run(clash) == [(1, "proprietary", 0, 3, 1.0)]
    plan = scan_licenses(documents((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan
