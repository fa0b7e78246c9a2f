"""Benchmark decontamination by greedy string tiling.

Seeds are the strings of ``min_tile`` tokens of the benchmark items. A document is tiled against
an item if the seeds that they share cover enough of the item; as every tile is made of seeds,
this leaves out no document. Tiling marks the longest common token strings that are still
unmarked on both sides first, found by running Karp-Rabin hashes of the item's and the
document's unmarked strings at a length found by bisection, until none of ``min_tile`` tokens
is left. The share of the
item's tokens that is marked is its coverage; reordered passages keep theirs, since tiles may
stand in any order.

The benchmark is a query set: it is read to the driver in blocks of at most ``block_bytes``
of text, and every block meets all documents in one pass without a shuffle. A task holds one
block's seeds and some documents at a time, so copies, hot sources and common passages cost
what their rows cost.

Defined results: tokens are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased.
An item shorter than a seed is its own seed; items and documents without a token match
nothing; null texts are empty. Very long items and texts take time in proportion to their
length for each length of a tile (and its bisection), not for each possible length. Repeated items are tiled once each, repeated rows get equal
rows; an empty benchmark or table gives none; other columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import fresh, written
from .tokens import HashIndex, constants, slices, span_hashes, text_bytes

#: Hits of seeds that are held at once; those of one text are at most the block's tokens.
HELD = 1 << 20
_U = np.uint64
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE = constants(1, 91)[0]
_INVERSE = pow(int(_BASE), -1, 1 << 64)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts in one buffer, and each text's bounds."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = _TOKEN[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | cut))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | cut))
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """The Karp-Rabin hash of every string of ``length`` tokens."""
    n = len(tokens) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = tokens[:n].copy()
    for k in range(1, length):
        out = out * _BASE + tokens[k : k + n]
    return out


class Strings:
    """Karp-Rabin hashes of all strings of some tokens, of any length, from prefix sums."""

    def __init__(self, tokens: np.ndarray) -> None:
        self.size = len(tokens)
        power, self.inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(self.size, b, _U)])) for b in (_BASE, _U(_INVERSE)))
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(tokens * power[:-1], dtype=_U)])

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Those of ``length`` tokens from the places ``at`` on."""
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]


def _clear(taken: np.ndarray, length: int) -> np.ndarray:
    """Places where ``length`` tokens stand of which none is taken."""
    sums = np.concatenate([[0], np.cumsum(taken)])
    return np.flatnonzero(sums[length:] == sums[: len(sums) - length]) if length < len(sums) else np.zeros(0, np.int64)


def tile(item: np.ndarray, text: np.ndarray, min_tile: int = 3) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the item, place in the text, length) of each tile.

    Of equally long matches the first in the item is marked first, at its first place in the
    text. Only text tokens that the item has can be in a tile, so the text is reduced to its
    runs of those. The longest length at which unmarked strings still match is found by
    bisection, all tiles of that length are marked, and the next one is looked for below it;
    when nothing of ``min_tile`` unmarked tokens matches any more, that shows at once.
    """
    known = np.isin(text, item)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    runs = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2]) if b - a >= min_tile]
    if not runs or len(item) < min_tile:
        return []
    # a taken place stands between runs, so that no string spans two of them
    where = np.concatenate([np.arange(a, b + 1) for a, b in runs])
    kept = text[np.minimum(where, len(text) - 1)]
    taken_item, taken_text = np.zeros(len(item), bool), np.zeros(len(where), bool)
    taken_text[np.cumsum([b - a + 1 for a, b in runs]) - 1] = True
    of_item, of_text = Strings(item), Strings(kept)

    def matches(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        i, p = _clear(taken_item, length), _clear(taken_text, length)
        if not len(i) or not len(p):
            return None
        h, g = of_item.hashes(i, length), of_text.hashes(p, length)
        met, other = np.isin(h, g), np.isin(g, h)
        return (i[met], h[met], p[other], g[other]) if met.any() else None

    tiles, most = [], min(len(item), max(b - a for a, b in runs))
    while most >= min_tile:
        found, length = matches(most), most
        if found is None:
            found = matches(min_tile)
            if found is None:
                break
            low, high = min_tile, most - 1
            while low < high:
                middle = (low + high + 1) // 2
                longer = matches(middle)
                if longer is None:
                    high = middle - 1
                else:
                    low, found = middle, longer
            length = low
        places: dict[int, deque[int]] = {}
        for p, g in zip(found[2].tolist(), found[3].tolist()):
            places.setdefault(g, deque()).append(p)
        for i, h in zip(found[0].tolist(), found[1].tolist()):
            if taken_item[i : i + length].any():
                continue
            there = places[h]
            while there and taken_text[there[0] : there[0] + length].any():
                there.popleft()  # it will not be free again
            for p in there:
                if not taken_text[p : p + length].any() and (item[i : i + length] == kept[p : p + length]).all():
                    taken_item[i : i + length] = taken_text[p : p + length] = True
                    tiles.append((i, int(where[p]), length))
                    break
        most = length - 1
    return tiles


@dataclass
class Seeds:
    """Items of one block and all their strings of ``min_tile`` tokens.

    The tokens of all items are numbered in one row; ``places[first[k]:first[k + 1]]`` are the
    numbers of the first tokens of the seed numbered k, ``owner`` tells a token's item.
    """

    ids: list
    items: list[np.ndarray]
    min_tile: int = 3
    index: HashIndex = field(default_factory=HashIndex)

    def __post_init__(self) -> None:
        size = np.array([len(item) for item in self.items], np.int64)
        start = np.cumsum(size) - size
        self.sizes, self.reach = size, np.minimum(max(self.min_tile, 1), size)
        self.owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
        keys = np.concatenate([rolling(item, n) for item, n in zip(self.items, self.reach.tolist())] or [np.zeros(0, _U)])
        keys[keys == 0] = 1
        places = np.concatenate([np.arange(s, s + n - r + 1) for s, n, r in zip(start, size, self.reach)] or [np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        distinct, counts = np.unique(keys, return_counts=True)
        self.index.add(distinct, np.arange(len(distinct), dtype=np.int32))
        self.first, self.places = np.concatenate([[0], np.cumsum(counts)]), places[order]
        self.lengths = np.unique(self.reach).tolist()

    def candidates(self, text: np.ndarray, bounds: np.ndarray, min_coverage: float) -> Iterator[tuple[int, int]]:
        """(text, item) wherever the seeds they share cover ``min_coverage`` of the item.

        Every tile is made of such seeds, so no text with that coverage by tiles is left out.
        """
        met = []
        for length in self.lengths:
            hashes = rolling(text, length)
            hashes[hashes == 0] = 1
            number = self.index.find(hashes)
            p = np.flatnonzero(number >= 0)
            doc = np.searchsorted(bounds, p, "right") - 1
            inside = p + length <= bounds[doc + 1]
            met.append(doc[inside] * len(self.first) + number[p[inside]])
        doc, seed = np.divmod(np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64), len(self.first))
        size = self.first[seed + 1] - self.first[seed]
        ends = np.cumsum(size)
        lo = 0
        while lo < len(doc):  # some whole texts at a time
            hi = int(np.searchsorted(ends, ends[lo] - size[lo] + HELD, "right"))
            if hi < len(doc):
                hi = int(max(np.searchsorted(doc, doc[hi]), np.searchsorted(doc, doc[lo], "right")))
            n = size[lo:hi]
            at = np.arange(int(n.sum())) + np.repeat(self.first[seed[lo:hi]] - (np.cumsum(n) - n), n)
            hits = np.sort(np.repeat(doc[lo:hi], n) * len(self.owner) + self.places[at])
            of, place = np.divmod(hits, len(self.owner))
            item = self.owner[place]
            # a seed covers its tokens up to the next one; the next item's are out of its reach
            covered = np.minimum(np.diff(hits, append=np.iinfo(np.int64).max), self.reach[item])
            pair = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (item[1:] != item[:-1])]))
            able = pair[np.add.reduceat(covered, pair) >= min_coverage * self.sizes[item[pair]]]
            yield from zip(of[able].tolist(), item[able].tolist())
            lo = hi


FOUND = "{id} {id_type}, item_id {item_type}, item_tokens long, covered long, n_tiles long, coverage double"


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    min_coverage: float = 0.5,
    min_tile: int = 3,
    block_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for each document and item of which at least ``min_coverage`` is tiled."""
    schema = FOUND.format(id=id_col, id_type=docs.schema[id_col].dataType.simpleString(), item_type=benchmark.schema[item_col].dataType.simpleString())
    given = docs.select(F.col(id_col), F.col(text_col))
    spark = docs.sparkSession
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    parts = []
    for ids, items in _blocks(benchmark.select(F.col(item_col), F.col(item_text_col)), block_bytes):
        sent = spark.sparkContext.broadcast(Seeds(ids, items, min_tile))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seeds = sent.value
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                rows, out = [], [[] for _ in range(5)]
                for lo, hi in slices(offsets):
                    part = data[offsets[lo] : offsets[hi]]
                    tokens, bounds = _tokens(part, offsets[lo : hi + 1] - offsets[lo])
                    for doc, k in seeds.candidates(tokens, bounds, min_coverage):
                        item = seeds.items[k]
                        tiles = tile(item, tokens[bounds[doc] : bounds[doc + 1]], min(min_tile, len(item)))
                        covered = sum(n for _, _, n in tiles)
                        if covered >= min_coverage * len(item):
                            rows.append(lo + doc)
                            for column, value in zip(out, (seeds.ids[k], len(item), covered, len(tiles), covered / len(item))):
                                column.append(value)
                ids_ = batch.column(0).take(pa.array(rows, pa.int64()))
                kinds = [item_type, pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([ids_, *(pa.array(x, t) for x, t in zip(out, kinds))], names=[id_col, "item_id", "item_tokens", "covered", "n_tiles", "coverage"])

        parts.append(given.mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.union, parts)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Item ids and tokens, read to the driver as far as a block goes, then the next."""
    ids, items, held = [], [], 0
    for row in benchmark.toLocalIterator():
        text = (row[1] or "").encode()
        tokens, _ = _tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        if len(tokens):
            ids.append(row[0])
            items.append(tokens)
            held += len(text)
        if held >= block_bytes:
            yield ids, items
            ids, items, held = [], [], 0
    if ids:
        yield ids, items


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = 0.5, min_tile: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold at least ``min_coverage`` of any item.

    Rows are told apart by id and text, so rows without id stand for themselves.
    """
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col)))
    hits = overlaps(keyed, benchmark, min_coverage, min_tile, id_col=key, text_col=text_col).select(key).distinct()
    return keyed.join(written(hits, "contaminated"), key, "left_anti").drop(key)
