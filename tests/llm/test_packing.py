import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lastmile.llm.packing import PieceIds, WordIds, coder, pack, pack_lengths
from lastmile.llm.queries import tokenizer_path
from lastmile.llm.tokens import words

from texts import rng, text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_pieces_cover_every_token_once(lengths):
    doc, start, length, seq, offset = pack_lengths(np.array(lengths), 16, 1.0, 0.1)
    at = [0] * len(lengths)
    for d, s, n in sorted(zip(doc, start, length)):
        assert s == at[d] and 0 < n <= 16
        at[d] += n
    assert at == lengths
    used = {}
    for q, o, n in sorted(zip(seq, offset, length)):
        assert o == used.get(q, 0)
        used[q] = o + n
    assert all(n <= 16 for n in used.values())
    assert len(used) == -(-sum(lengths) // 16)  # no sequence more than the tokens need


def test_descending_pieces_go_to_the_lowest_cost():
    doc, _, length, seq, _ = pack_lengths(np.array([8, 7, 5, 5, 4, 3]), 16, 1.0, 1.0)
    by = {d: q for d, q in zip(doc, seq)}
    # 8 | 7, then 5 to the cheaper second, 5 to the first (8: 72, 7+5: 86), 4 to the second, 3 to the first
    assert [int(by[d]) for d in range(6)] == [0, 1, 1, 0, 1, 0] and length.sum() == 32


def test_ids_equal_the_tokenizers(spark, documents):
    from tokenizers import Tokenizer

    r = rng(3)
    texts = [text(r, n) for n in (3, 40, 400, 5000)] + ["", None, "  \n ", "It's <|endoftext|> a b İß 12 3!!é", "x" * 3000, text(r, 40)]
    rows = list(enumerate(texts)) + [(100, texts[1]), (None, "null id")]
    found = pack(documents(*rows), tokenizer_path(), capacity=64).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    got = {}
    for p in sorted(found, key=lambda p: (p.doc_id is None, p.doc_id, p.start)):
        assert p.start == len(got.setdefault(p.doc_id, [])) and p.doc_tokens == len(expected[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == expected


def test_blocks_and_repeats(spark, documents):
    rows = [(1, "one two three")] * 50
    found = pack(documents(*rows, n=1), tokenizer_path(), capacity=8, block_tokens=16).collect()
    assert sum(p.length for p in found) == 50 * found[0].doc_tokens
    places = sorted((p.sequence_id, p.offset, p.length) for p in found)
    for (q, o, n), (q2, o2, _) in zip(places, places[1:]):
        assert o2 == (o + n if q2 == q else 0)


class Counting:
    """A tokenizer that counts the texts and the words it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts, self.words = tokenizer, 0, 0

    def encode_batch(self, texts, **options):
        self.texts += len(texts)
        self.words += sum(len(t.split(" ")) for t in texts)
        return self.tokenizer.encode_batch(texts, **options)


def test_new_words_are_encoded_together_and_those_met_again_stay():
    coder = WordIds(tokenizer_path(), most=100)
    counting = coder.tokenizer = Counting(coder.tokenizer)
    plain = counting.tokenizer
    common = [f"common{chr(97 + k)}" for k in range(20)] + ["\u0301a", "İß", "\u00a0", "<|endoftext|>x", "It's", "e\u0301", "ᄀ", "ᅡ"]
    met = 0
    for k in range(6):
        said = 2 * common + [f"rare{k}x{j}" for j in range(80)]
        part = next(words(pa.array([" ".join(said)])))
        ids, _ = coder.encode(part)
        assert ids.tolist() == [i for w in said for i in plain.encode(w, add_special_tokens=False).ids]
        met += len(said)
    assert counting.words == len(common) + 6 * 80 < met
    assert counting.texts < counting.words / 20


def test_each_piece_is_encoded_once_whatever_its_case_and_marks():
    known = coder(tokenizer_path())
    said = ["été", "garden", "Ärger", "x"]
    marked = [w.title() + m if n % 2 else w + m for w in said for n, m in enumerate(["", ",", ".", "!", ")", "(7)"])]
    (part,) = words(pa.array([" ".join(marked)]))
    ids, _ = known.encode(part)
    assert ids.tolist() == known.tokenizer.encode(" ".join(marked), add_special_tokens=False).ids
    assert known.index.count == len(said) + len([",", ".", "!", ")", "(", "7"])


def test_pieces_give_the_tokenizers_ids():
    known = PieceIds(tokenizer_path(), most=500)
    parts = [*map(chr, range(1, 0x180)), *" aÀÉéßÿÞ×÷09.,'<" * 8, "<|endoftext|>", "'s", "e\u0301", "\u0323", "\u0085", "\u2028", "Σ", "中文", "\U0001f600"]
    r = rng(5)
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(1500)]
    for part in words(pa.array(texts), 2000):
        ids, at = known.encode(part)
        for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
            assert ids[a:b].tolist() == known.tokenizer.encode(texts[part.first + k], add_special_tokens=False).ids


def test_broken_characters_stay_whole():
    known = coder(tokenizer_path())
    raw = [b"ab\xc3", b"\xa9t\xc3\xa9 \xc3", b"x"]
    data = np.frombuffer(b"".join(raw), np.uint8)
    column = pa.Array.from_buffers(pa.string(), 3, [None, pa.py_buffer(np.array([0, 3, 9, 10], np.int32)), pa.py_buffer(data)])
    (part,) = words(column)
    ids, at = known.encode(part)
    for k, x in enumerate(raw):
        assert ids[at[k] : at[k + 1]].tolist() == known.tokenizer.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids


def test_another_tokenizer_gets_whole_words(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    other = Tokenizer(models.WordLevel({"Up": 1, "up,": 2, "?": 3}, unk_token="?"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(path := str(tmp_path / "other.json"))
    (part,) = words(pa.array(["Up up, up", None]))
    assert coder(path).encode(part)[0].tolist() == [1, 2, 3]


def test_a_worker_holds_little_between_tasks():
    known = coder(tokenizer_path())
    for k in range(0, 200_000, 50_000):
        for part in words(pa.array([" ".join(map(str, range(k, k + 50_000)))])):
            known.encode(part)
    assert known.index.count == 10  # the digits
    assert known.most <= 1 << 19


def test_empty_table(spark, documents):
    assert pack(documents(), tokenizer_path()).count() == 0
