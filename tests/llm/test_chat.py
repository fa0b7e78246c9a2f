import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lastmile.llm import chat
from lastmile.llm.chat import Malformed, format_conversations, formatted_digests, parse, read_back, render, unescaped

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = st.lists(st.sampled_from(["\\", "### ", "</turn>", ": ", "\n", "#", "<", "a", " ", "é", "user", "</turn", "###", ":"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4))
def test_any_turns_come_back(turns):
    rendered = [render(role, text) for role, text in turns]
    formatted = "".join(f for f, _, _ in rendered)
    back = list(parse(formatted))
    assert [(r, t) for r, t, _, _ in back] == turns
    assert [unescaped(formatted[a:b]) for _, _, a, b in back] == [t for _, t in turns]


def test_only_conflicting_content_is_escaped():
    assert render("user", r"a \ b \\ ## c </turn d")[0] == "### user: a \\ b \\\\ ## c </turn d</turn>\n"
    assert render("user", r"\### Assistant: </turn> ok")[0] == "### user: \\\\\\### Assistant: \\</turn> ok</turn>\n"
    assert render("user", "end\\")[0] == "### user: end\\\\</turn>\n"
    assert render("a: b", "x")[0] == "### a\\: b: x</turn>\n"


@pytest.mark.parametrize("bad", ["x", "### user", "### user: abc", "### user: a</turn>", "### user: a ### b</turn>\n", "### u</turn>: a</turn>\n", "### a: b</turn> \n"])
def test_the_parser_refuses_what_is_not_in_the_grammar(bad):
    with pytest.raises(Malformed):
        list(parse(bad))


def brute(rows):
    out, by = [], {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, _, r, _, t in turns if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for _, _, r, _, t in turns)
        size = sum(len(render(r, t)[0]) for _, _, r, _, t in turns)
        out.append((conv, len(turns), hashlib.sha256(every.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), size))
    return sorted(out, key=str)


def rows_of(spark, rows, n=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(n)


def some():
    rows = [(c, t, ("user", "assistant", "system", None)[(c + t) % 4], f"text {c * t} </turn> é\\") for c in range(40) for t in range(c % 7 + 1)]
    rows += [(100, t, "assistant" if t % 2 else "user", "word " * (t % 50)) for t in range(600)]  # one with most of the rows
    rows += [(101, 0, "user", None), (101, None, "assistant", "last"), (101, 0, "user", None), (101, 0, "assistant", ""), (None, 3, "assistant", "no id"), (102, 0, "assistant", "x" * 50_000)]
    return rows + [(103, 0, "user", "same")] * 200


@pytest.mark.parametrize("record", [1, 500, 1 << 18])
def test_equals_brute_force(spark, monkeypatch, record):
    monkeypatch.setattr(chat, "RECORD", record)
    assert sorted((tuple(r) for r in formatted_digests(rows_of(spark, some())).collect()), key=str) == brute(some())


def test_a_large_conversation_is_spread_over_tasks_and_stays_in_order(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn number {t}") for t in range(2000)] + [(c, 0, "user", "hi") for c in range(2, 50)]
    records = format_conversations(rows_of(spark, rows, 5))
    found = records.filter("conv_id = 1").orderBy("part", "record").collect()
    assert len({r.part for r in found}) >= 3
    text = "".join(r.formatted for r in found)
    assert [t for _, t, _, _ in parse(text)] == [f"turn number {t}" for t in range(2000)]
    spans = ["".join(unescaped(r.formatted[s.start : s.end]) for s in r.loss) for r in found]
    assert "".join(spans) == "".join(f"turn number {t}" for t in range(0, 2000, 2))
    assert not any(r.alone for r in found)


def test_equal_rows_are_spread_too(spark):
    rows = rows_of(spark, [(1, 0, "user", "same")] * 4000 + [(2, 0, "user", "x")])
    assert len({r.part for r in format_conversations(rows).filter("conv_id = 1").collect()}) >= 3
    assert [r.n_turns for r in formatted_digests(rows).orderBy("conv_id").collect()] == [4000, 1]


def test_empty_table_other_names_and_clashing_columns(spark):
    assert formatted_digests(rows_of(spark, [])).count() == 0
    df = rows_of(spark, some()[:30]).withColumns({c: F.lit("x") for c in ("id", "part", "record", "digest", "row", "alone", "loss", "formatted")})
    assert sorted((tuple(r) for r in formatted_digests(df).collect()), key=str) == brute(some()[:30])
    renamed = rows_of(spark, some()[:30]).toDF("c", "k", "who", "said")
    got = read_back(format_conversations(renamed, "c", "k", "who", "said"), "c")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(some()[:30])
