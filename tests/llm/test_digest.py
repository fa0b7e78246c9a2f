import hashlib

from lastmile.llm.digest import digest, edited_fingerprints, fingerprints, likeness, read_digest, written_digest

from texts import rng, text


def brute(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + nxt[:n] if n else t
        a, b, c = (digest(x.encode()) for x in (t, edited, nxt))
        out[i] = (len(t), edited, written_digest(a), written_digest(b), likeness(a, b), likeness(a, c))
    return out


def test_equals_brute_force_over_any_number_of_runs(spark, documents):
    r = rng(5)
    rows = [(i * i, text(r, r.choice([0, 1, 2, 30, 300]), r.choice(["en", "fr"]))) for i in range(60)] + [(10_000, None), (10_001, "é")]
    for runs in (1, 3, 16, 200):
        found = edited_fingerprints(documents(*rows), runs=runs).collect()
        assert {x[0]: tuple(x)[1:] for x in found} == brute(rows)


def test_alone_repeated_and_null_ids(spark, documents):
    (one,) = edited_fingerprints(documents((7, "abcdef"))).collect()
    assert one.edited_text == "abcdab" and one.near_next == 1.0
    found = edited_fingerprints(documents((1, "aaa"), (1, "bbb"), (1, "aaa"), (None, "ccc"), (2, "ddd"))).collect()
    assert len(found) == 5 and sorted(str(x.doc_id) for x in found) == ["1", "1", "1", "2", "None"]
    assert next(x for x in found if x.doc_id is None).edited_text == "ccd"
    assert edited_fingerprints(documents()).count() == 0


def test_likeness_orders_copies_edits_and_others(spark):
    r = rng(9)
    a, b = (text(r, 400) for _ in range(2))
    edited = a[: 2 * len(a) // 3] + b[: len(a) // 3]
    x, y, z = (digest(t.encode()) for t in (a, edited, b))
    assert likeness(x, x) == 1.0 and 1.0 > likeness(x, y) > likeness(x, z) >= 0.0
    assert (read_digest(written_digest(x)) == x).all()
    assert likeness(digest(b""), digest(b"")) == 1.0


def test_chunks_of_a_long_text_count_as_one(monkeypatch):
    long = text(rng(2), 2000).encode()
    whole = digest(long)
    monkeypatch.setattr("lastmile.llm.digest._CHUNK", 100)
    assert (digest(long) == whole).all()


def test_fingerprints_of_a_table(spark, documents):
    found = fingerprints(documents((1, "same text here"), (2, "same text here"), (3, None), (4, "")), name="f").collect()
    by = {r.doc_id: r.f for r in found}
    assert by[1] == by[2] and by[3] == by[4] and by[1] != by[3]


def test_query_columns(spark, documents, tmp_path):
    from lastmile.llm.queries import op1_document_fingerprints

    documents((1, "abcdef"), (2, "ghi")).write.parquet(f"{tmp_path}/documents.parquet")
    row = next(r for r in op1_document_fingerprints(spark, str(tmp_path)).collect() if r.doc_id == 2)
    assert (row.n_chars, row.edited_sha256) == (3, hashlib.sha256(b"gha").hexdigest())
