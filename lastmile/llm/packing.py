"""Packing: token sequences of a fixed capacity, balanced by attention cost.

A piece of n tokens costs ``linear * n + quadratic * n**2`` (attention stays inside a
piece). Each task packs its own documents block by block, a block being about
``block_tokens`` tokens: as many sequences as the tokens fill are opened, documents are cut
at the capacity, and the pieces go, dearest first, to the lowest-cost sequence with room for
them. A piece that fits nowhere is cut at the roomiest sequence, so only the last sequence of
a block keeps padding. Nothing is shuffled; hot sources or keys play no part.

Tokens: white space separates words before the tokenizer does anything that could join
them, so a text's ids are those of its words. If the tokenizer lower-cases and then cuts words
into runs of letters, digits and runs of marks, words of ASCII and of the letters À to ÿ are
cut and lower-cased here, and its model sees each distinct piece; other words stay whole. Each
worker keeps a bounded table of what it has met; when that is full, pieces and words met once
go. New words are encoded some at a time, joined by spaces, and told apart by the ids' offsets.

Defined results: null and empty texts are the end token alone; documents longer than the
capacity become several pieces; equal rows are packed as separate documents; an empty table
gives no rows; other columns are not read. Which documents share a sequence depends on how
the input is split; that every id lies in exactly one piece doesn't.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tokens import LOWERED, HashIndex, Words, words

_U = np.uint64

PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"


#: What a tokenizer does to a text before its model sees it, for ``pieces`` to do the same.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: Kinds of bytes. Words with an ``OTHER`` one stay whole: ``'`` may begin a contraction and ``<`` a special token.
BLANK, LETTER, DIGIT, MARK, OTHER = range(5)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[33:127] = MARK
_KIND[[39, 60]] = OTHER
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KIND[[32, *range(9, 14)]] = BLANK
_LATIN = 0xC3  # first byte of À to ÿ
#: The character by which byte-level tokenizers show each byte.
BYTE_CHARS = np.arange(256, dtype="<u4")
_HIDDEN = [b for b in range(256) if b < 33 or 127 <= b < 161 or b == 173]
BYTE_CHARS[_HIDDEN] = 256 + np.arange(len(_HIDDEN))


def pieces(part: Words) -> tuple[Words, np.ndarray]:
    """The words cut into runs of letters, digits and runs of marks, lower-cased; words with
    other bytes whole and as they are, and which those are."""
    data, starts, ends = part.data, part.starts, part.ends
    if not len(starts):
        return part, np.zeros(0, bool)
    kind = np.take(_KIND, data)
    second = np.flatnonzero(data[:-1] == _LATIN) + 1
    after = data[second]
    second = second[(after & 0xC0 == 0x80) & (after != 0x97) & (after != 0xB7)]  # not × and ÷
    kind[second] = kind[second - 1] = LETTER
    begin = part.offsets[(part.offsets > 0) & (part.offsets < len(data))]
    begin = begin[data[begin] & 0xC0 == 0x80]  # broken characters
    kind[begin] = kind[begin - 1] = OTHER

    whole = np.maximum.reduceat(kind, starts) == OTHER
    lowered = np.take(LOWERED, data)
    second = second[data[second] < 0x9F]
    lowered[second] += 0x20
    if whole.any():
        step = np.zeros(len(data) + 1, np.int8)
        step[starts[whole]] += 1
        step[ends[whole]] -= 1
        inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
        kind[inside] = OTHER
        np.copyto(lowered, data, where=inside)

    first = np.zeros(len(data), bool)
    first[1:] = (kind[1:] != BLANK) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    first[starts] = True
    last = np.zeros(len(data) + 1, bool)
    last[1:-1] = first[1:] & (kind[:-1] != BLANK)
    last[ends] = True
    starts = np.flatnonzero(first)
    cut = Words(part.first, lowered, part.offsets, starts, np.flatnonzero(last), np.searchsorted(starts, part.offsets))
    return cut, kind[starts] == OTHER


class WordIds:
    """Token ids of words, each distinct word encoded once while the table has room."""

    JOINED = 64  # words encoded as one text

    def __init__(self, path: str, most: int = 1 << 19) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.index = Tokenizer.from_file(path), most, HashIndex()
        self._keep(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _keep(self, hashes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """The table holds these words and no others."""
        n = len(hashes)
        self.index.clear()
        self.index.add(hashes, np.arange(n, dtype=np.int32))
        self.hashes, self.lengths, self.pool, self.filled = hashes.copy(), lengths.copy(), ids.copy(), len(ids)
        self.starts, self.again = np.cumsum(lengths) - lengths, np.zeros(n, bool)

    def _forget(self) -> None:
        """Words that were met again stay, as long as they leave half of the room."""
        kept = np.flatnonzero(self.again[: self.index.count])[: self.most // 2]
        self._keep(self.hashes[kept], self.lengths[kept], self._ids(kept))

    def _ids(self, n: np.ndarray) -> np.ndarray:
        """The ids of words by their numbers, one after the other."""
        lengths = np.take(self.lengths, n)
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(np.take(self.starts, n) - (ends - lengths), lengths)
        return np.take(self.pool, at)

    def _encoded(self, said: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number of ids, and the ids."""
        joined = [said[k : k + self.JOINED] for k in range(0, len(said), self.JOINED)]
        ids, word, base = [], [], 0
        for some, e in zip(joined, self.tokenizer.encode_batch([" ".join(x) for x in joined], add_special_tokens=False)):
            begin = np.cumsum([0] + [len(w) + 1 for w in some[:-1]])
            ids += e.ids
            word.append(base + np.searchsorted(begin, [a for a, _ in e.offsets], "right") - 1)
            base += len(some)
        return np.bincount(np.concatenate(word), minlength=len(said)), np.array(ids, np.uint32)

    def _learn(self, part: Words, hashes: np.ndarray, missing: np.ndarray, encoded=None) -> None:
        new, first, times = np.unique(hashes[missing], return_index=True, return_counts=True)
        where = missing[first]
        raw = part.data.tobytes()
        said = [raw[s:e].decode("utf-8", "replace") for s, e in zip(part.starts[where].tolist(), part.ends[where].tolist())]
        lengths, ids = (encoded or self._encoded)(said)
        n, filled = self.index.count, self.filled
        self.index.add(new, np.arange(n, n + len(new), dtype=np.int32))
        for name, at, x in (
            ("hashes", n, new),
            ("lengths", n, lengths),
            ("starts", n, filled + np.cumsum(lengths) - lengths),
            ("again", n, times > 1),
            ("pool", filled, ids),
        ):
            setattr(self, name, _put(getattr(self, name), at, x))
        self.filled += len(ids)

    def encode(self, part: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the part's words, and where each document's begin (one more than documents)."""
        hashes = part.hashes(lower=False)
        hashes[hashes == 0] = 1
        if self.index.count > self.most:
            self._forget()
        n = self.index.find(hashes)
        missing = np.flatnonzero(n < 0)
        self.again[n[n >= 0] if len(missing) else n] = True
        if len(missing):
            self._learn(part, hashes, missing)
            n[missing] = self.index.find(hashes[missing])
        ends = np.cumsum(np.take(self.lengths, n))
        return self._ids(n), np.concatenate([[0], ends])[part.bounds]


class PieceIds(WordIds):
    """The same for a tokenizer that cuts words as ``pieces`` does: each distinct piece is encoded once."""

    def suits(self) -> bool:
        steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        special = self.tokenizer.get_added_tokens_decoder().values()
        return all(steps) and [json.loads(x.__getstate__()) for x in steps] == [NORMALIZER, PRE_TOKENIZER] and all("<" in x.content for x in special)

    def _modelled(self, said: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``, of pieces that only the model is left to see."""
        tokenize, ids, lengths = self.tokenizer.model.tokenize, [], []
        joined = np.frombuffer(" ".join(said).encode(), np.uint8)
        shown = np.take(BYTE_CHARS, joined).tobytes().decode("utf-32-le")
        for x in shown.split(chr(BYTE_CHARS[32])):
            found = tokenize(x)
            ids += [t.id for t in found]
            lengths.append(len(found))
        return np.array(lengths, np.int64), np.array(ids, np.uint32)

    def _learn(self, part: Words, hashes: np.ndarray, missing: np.ndarray, encoded=None) -> None:
        whole = self.whole[missing]
        for some, encoded in ((missing[~whole], self._modelled), (missing[whole], self._encoded)):
            if len(some):
                super()._learn(part, hashes, some, encoded)

    def encode(self, part: Words) -> tuple[np.ndarray, np.ndarray]:
        part, self.whole = pieces(part)
        return super().encode(part)


def coder(path: str) -> WordIds:
    found = PieceIds(path)
    return found if found.suits() else WordIds(path)


def _put(held: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``held`` with ``new`` from ``at`` on; it doubles as it fills."""
    if at + len(new) > len(held):
        held = np.concatenate([held[:at], np.zeros(max(at, 1024) + len(new), held.dtype)])
    held[at : at + len(new)] = new
    return held


_coders: dict[str, WordIds] = {}  # one for each file and Python worker


def pack_lengths(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> tuple[np.ndarray, ...]:
    """(document, start, length, sequence, offset) of the pieces of documents of such lengths."""
    lengths = np.asarray(lengths, np.int64)
    n_sequences = -(-int(lengths.sum()) // capacity)
    cuts = lengths // capacity
    whole = np.repeat(np.arange(len(lengths)), cuts)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    done = [(whole, nth * capacity, np.full(len(whole), capacity), np.arange(len(whole)), np.zeros(len(whole), np.int64))]

    open_ = n_sequences - len(whole)
    cost, room = np.zeros(open_), np.full(open_, capacity, np.int64)
    left = lengths % capacity
    queue = [(-int(left[i]), int(i), int(cuts[i]) * capacity) for i in np.flatnonzero(left)]
    heapq.heapify(queue)
    found: list[tuple[int, int, int, int, int]] = []
    while queue:
        minus, doc, start = heapq.heappop(queue)
        length = -minus
        fits = np.where(room >= length, cost, np.inf)
        to = int(fits.argmin())
        if fits[to] == np.inf:
            to = int(room.argmax())
            length = int(room[to])
            heapq.heappush(queue, (minus + length, doc, start + length))
        found.append((doc, start, length, len(whole) + to, capacity - int(room[to])))
        room[to] -= length
        cost[to] += linear * length + quadratic * length * length
    done.append(tuple(np.array(found, np.int64).reshape(-1, 5).T))
    return tuple(np.concatenate([a, b]) for a, b in zip(*done))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    block_tokens: int = 1 << 21,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of ``docs`` in sequences: ``ids`` are little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a tokenizers file whose pre-tokenizer splits at white space;
    every document ends with ``end_id``.
    """
    id_type = docs.schema[id_col].dataType

    def block(keys: list, ids: list[np.ndarray], first: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(x) for x in ids], np.int64)
        doc, start, length, seq, offset = pack_lengths(lengths, capacity, linear, quadratic)
        key = pa.concat_arrays(keys) if len(keys) > 1 else keys[0]
        for lo in range(0, len(doc), 2048):
            d, s, n = doc[lo : lo + 2048], start[lo : lo + 2048], length[lo : lo + 2048]
            data = np.concatenate([ids[i][a : a + k] for i, a, k in zip(d, s, n)]).astype("<u4")
            at = np.concatenate([[0], np.cumsum(n * 4)]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer(at), pa.py_buffer(data)])
            cost = linear * n + quadratic * n * n.astype(float)
            columns = [key.take(pa.array(d)), s, n, packed, lengths[d], seq[lo : lo + 2048] + first, offset[lo : lo + 2048], cost]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=PIECES_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _coders:
            _coders[tokenizer] = coder(tokenizer)
        known = _coders[tokenizer]
        first = TaskContext.get().partitionId() << 32
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in words(batch.column(1)):
                found, at = known.encode(part)
                keys.append(batch.column(0).slice(part.first, len(at) - 1))
                ids += [np.append(found[a:b], np.uint32(end_id)) for a, b in zip(at[:-1], at[1:])]
                held += len(found) + len(at) - 1
                if held >= block_tokens:
                    yield from block(keys, ids, first)
                    first += -(-held // capacity)
                    keys, ids, held = [], [], 0
        if ids:
            yield from block(keys, ids, first)

    return docs.select(id_col, text_col).mapInArrow(run, PIECES.format(id=id_type.simpleString()))


PIECES_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"]
