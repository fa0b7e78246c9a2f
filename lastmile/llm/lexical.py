"""Ranked lexical search over a document FP-tree.

Every item's terms are looked up in all documents, and each item keeps its ``k`` best. A
document is read once: what stays of it is its number of terms and its restricted vector,
the terms that any item holds with their counts. Those vectors are written as a table, from
which the corpus figures come (documents, terms, documents per term).

The search reads that table block by block. A block's vectors, their terms ordered by
document frequency, are sorted, so that documents with the same frequent terms share a path
of a prefix tree. Every node knows the largest count of each term and the smallest length
factor ``m`` of the documents below it, hence a bound on the score that an item can reach
there. The tree is walked depth first with all items that can still gain something; an item
leaves a subtree whose bound is below its k-th score so far (or equal to it, with no smaller
id below), and what is left at a leaf is scored exactly. Tasks hand over ``k`` rows an item,
so what is shuffled doesn't depend on the documents.

Terms are the maximal runs of ASCII letters, digits and all code points from 128 on; only
A-Z is lower-cased. The score is stated in ``lexical_search``.

Defined results: null and empty texts hold no term and are not counted; an item without
terms finds nothing. Every row of the documents counts and is ranked by itself, also with a
repeated or null id (null ids come last among equal scores). Equal rows of the items count
once; rows of one id with other texts are items of their own. Very long texts are counted in
pieces cut between terms. Columns other than the id and the text are not read, so their
names can't clash. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Entries of restricted vectors (document and term) that one tree holds, about.
TREE = 400_000
#: Documents below which a subtree is scored as one leaf.
LEAF = 48

_KEPT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c for c in _KEPT)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, as lists of a piece each."""
    spaced, lo = text.translate(_TO_TERMS), 0
    while len(spaced) - lo > PIECE:
        hi = spaced.rfind(b" ", lo, lo + PIECE)
        hi = hi if hi > lo else spaced.find(b" ", lo + PIECE)
        if hi < 0:
            break
        yield spaced[lo:hi].split()
        lo = hi
    yield spaced[lo:].split()


class Items:
    """A block of items: its vocabulary, and each item's terms with their repeats."""

    def __init__(self) -> None:
        self.ids: list = []
        self.vocabulary: dict[bytes, int] = {}
        self.counts: list[Counter] = []

    def add(self, item_id, text: bytes) -> None:
        held = Counter(t for piece in terms_of(text) for t in piece)
        if held:
            self.ids.append(item_id)
            self.counts.append(Counter({self.vocabulary.setdefault(t, len(self.vocabulary)): n for t, n in held.items()}))


class Weighted:
    """The items of a block by term: who holds it, and its weight times its repeats there.

    Terms are renumbered by falling document frequency (then by number), the order in which
    a document's terms stand on its path.
    """

    def __init__(self, items: Items, n_docs: int, n_terms: int, df: np.ndarray) -> None:
        self.n_docs, self.n_terms, self.n_items = n_docs, n_terms, len(items.ids)
        self.rank = np.empty(len(df), np.int64)
        self.rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
        held = sorted((int(self.rank[t]), k, weight[t] * n) for k, c in enumerate(items.counts) for t, n in c.items())
        self.owner = np.array([k for _, k, _ in held], np.int64)
        self.weight = np.array([w for _, _, w in held], np.int64)
        self.first = np.searchsorted(np.array([t for t, _, _ in held]), np.arange(len(df) + 1))
        # below this bound every sum of scores is exact in doubles
        self.in_doubles = max(sum(weight[t] * n for t, n in c.items()) for c in items.counts) * 10**6 < 2**53

    def m(self, n: int) -> int:
        return 100 - 75 + (75 * n * self.n_docs) // self.n_terms

    def held(self, terms: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``terms``, item's column, weight) wherever an item with a column holds a term."""
        size = self.first[terms + 1] - self.first[terms]
        at = np.arange(int(size.sum())) + np.repeat(self.first[terms] - (np.cumsum(size) - size), size)
        col = column[self.owner[at]]
        ok = col >= 0
        return np.repeat(np.arange(len(terms)), size)[ok], col[ok], self.weight[at][ok]


def gain(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """What a term's count gives before its weight; grows with ``tf``, falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """Documents of a block, sorted by their paths; nodes are runs of them.

    ``nodes`` stand in depth-first order with the number of nodes in their subtree, so a
    subtree is left by a jump. Documents of one vector and length are one entry, with the
    ``k`` smallest ids (they tie, and no more than ``k`` can be among the best).
    """

    def __init__(self, ids: list, lengths: list[int], bounds: np.ndarray, terms: np.ndarray, tf: np.ndarray, by: Weighted, k: int) -> None:
        doc = np.repeat(np.arange(len(ids)), np.diff(bounds))
        order = np.lexsort((by.rank[terms], doc))
        ranks, tf = by.rank[terms][order], tf[order].astype(np.int64)
        path, counts, cut = ranks.astype(">i4").tobytes(), tf.astype(">i8").tobytes(), bounds.tolist()
        keyed = sorted(range(len(ids)), key=lambda d: (path[4 * cut[d] : 4 * cut[d + 1]], counts[8 * cut[d] : 8 * cut[d + 1]], lengths[d], ids[d] is None, ids[d]))
        self.ids: list[list] = []
        taken, last = [], None
        for d in keyed:
            key = (path[4 * cut[d] : 4 * cut[d + 1]], counts[8 * cut[d] : 8 * cut[d + 1]], lengths[d])
            if key != last:
                last = key
                taken.append(d)
                self.ids.append([])
            if len(self.ids[-1]) < k:
                self.ids[-1].append(ids[d])
        taken = np.array(taken, np.int64)
        size = np.diff(bounds)[taken]
        self.first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(int(size.sum())) + np.repeat(bounds[taken] - self.first[:-1], size)
        self.terms, self.tf = ranks[at], tf[at]
        self.m = np.array([by.m(lengths[d]) for d in taken.tolist()], np.int64)
        self._grow()

    def _children(self, lo: int, hi: int, depth: int) -> tuple[int, list[int]]:
        """Depth at which the paths of a run part, and where its children begin; small
        siblings that stand together are one child."""
        start = self.first[lo:hi]
        shortest = int((self.first[lo + 1 : hi + 1] - start).min())
        a, b = self.terms[start[0] : start[0] + shortest], self.terms[start[-1] : start[-1] + shortest]
        apart = np.flatnonzero(a[depth:] != b[depth:])  # sorted: what the ends share, all share
        depth = depth + int(apart[0]) if len(apart) else shortest
        after = start + depth
        ended = after >= self.first[lo + 1 : hi + 1]
        step = np.where(ended, -1, self.terms[np.minimum(after, len(self.terms) - 1)])
        edges = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), hi - lo]
        begins, begun = [0], 0
        for x, y in zip(edges[1:], edges[2:]):
            if y - begun > LEAF:
                begins.append(x)
                begun = x
        return depth, [lo + x for x in begins]

    def _grow(self) -> None:
        self.lo, self.hi, self.leaf, self.skip, above = [], [], [], [], []
        todo = [(0, len(self.ids), 0, -1)] if self.ids else []
        while todo:
            lo, hi, depth, parent = todo.pop()
            number = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            above.append(parent)
            self.skip.append(1)
            begins = [lo]
            if hi - lo > LEAF:
                depth, begins = self._children(lo, hi, depth)
            # a run of equal paths (other counts) can't be parted by terms: cut it anyhow
            if len(begins) == 1 and hi - lo > LEAF:
                begins = list(range(lo, hi, LEAF))
            self.leaf.append(len(begins) == 1)
            if len(begins) > 1:
                for x, y in reversed(list(zip(begins, [*begins[1:], hi]))):
                    todo.append((x, y, depth, number))
        held: list[list] = [[] for _ in self.lo]
        self.bounds: list = [None] * len(self.lo)
        for v in range(len(self.lo) - 1, -1, -1):
            if self.leaf[v]:
                part = slice(self.first[self.lo[v]], self.first[self.hi[v]])
                terms, tf = self.terms[part], self.tf[part]
                m, low = int(self.m[self.lo[v] : self.hi[v]].min()), min((i is None, i) for x in self.ids[self.lo[v] : self.hi[v]] for i in x)
            else:
                terms, tf = (np.concatenate([x[i] for x in held[v]]) for i in (0, 1))
                m, low = min(x[2] for x in held[v]), min(x[3] for x in held[v])
            order = np.argsort(terms, kind="stable")
            at = np.flatnonzero(np.diff(terms[order], prepend=-1))
            self.bounds[v] = (terms[order][at], np.maximum.reduceat(tf[order], at) if len(at) else tf, m, low)
            held[v] = []
            if above[v] >= 0:
                held[above[v]].append(self.bounds[v])
                self.skip[above[v]] += self.skip[v]


class Best:
    """The ``k`` best (score, then smallest id) of every item so far."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.found: list[list] = [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, np.int64)  # the k-th score; 0 while there are fewer

    def add(self, item: int, score: int, doc_id) -> None:
        rows = self.found[item]
        entry = (-score, doc_id is None, doc_id)
        if len(rows) == self.k:
            if self._worse(entry, rows[-1]):
                return
            rows.pop()
        insort(rows, entry, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))
        if len(rows) == self.k:
            self.least[item] = -rows[-1][0]

    @staticmethod
    def _worse(a: tuple, b: tuple) -> bool:
        return a[:2] >= b[:2] if a[:2] != b[:2] or a[1] else a[2] >= b[2]

    def able(self, items: np.ndarray, bound: np.ndarray, low: tuple) -> np.ndarray:
        """Which items can still gain from documents of these bounds and ids from ``low`` on."""
        least = self.least[items]
        ok = (bound > least) & (bound > 0)
        for x in np.flatnonzero((bound == least) & (least > 0)):
            ok[x] = not self._worse((-int(bound[x]), *low), self.found[items[x]][-1])
        return ok


def search_tree(tree: Tree, by: Weighted, best: Best) -> int:
    """Depth-first branch and bound of all items over one tree; returns the pairs (document, item)
    that were scored."""
    scored, v = 0, 0
    waiting: list[tuple[int, np.ndarray]] = [(len(tree.lo), np.arange(by.n_items))]
    while v < len(tree.lo):
        while v >= waiting[-1][0]:
            waiting.pop()
        items = waiting[-1][1]
        terms, tf, m, low = tree.bounds[v]
        column = np.full(by.n_items, -1)
        column[items] = np.arange(len(items))
        place, col, weight = by.held(terms, column)
        ok = best.able(items, _sums(col, gain(tf, m)[place] * weight, len(items), by.in_doubles), low)
        if not ok.any():
            v += tree.skip[v]
            continue
        if not tree.leaf[v]:
            waiting.append((v + tree.skip[v], items[ok]))
            v += 1
            continue
        lo, hi = tree.lo[v], tree.hi[v]
        part = slice(tree.first[lo], tree.first[hi])
        row = np.repeat(np.arange(hi - lo), np.diff(tree.first[lo : hi + 1]))
        kind = np.float64 if by.in_doubles else np.int64
        given = np.zeros((hi - lo, len(terms)), kind)
        given[row, np.searchsorted(terms, tree.terms[part])] = gain(tree.tf[part], tree.m[lo:hi][row])
        items = items[ok]
        column[:] = -1
        column[items] = np.arange(len(items))
        place, col, weight = by.held(terms, column)
        asked = np.zeros((len(terms), len(items)), kind)
        asked[place, col] = weight
        scores = (given @ asked).astype(np.int64)
        scored += (hi - lo) * len(items)
        for d, x in zip(*np.nonzero((scores > 0) & (scores >= best.least[items]))):
            for doc_id in tree.ids[lo + d]:
                best.add(int(items[x]), int(scores[d, x]), doc_id)
        v += 1
    return scored


def _sums(place: np.ndarray, values: np.ndarray, n: int, in_doubles: bool) -> np.ndarray:
    if in_doubles:
        return np.bincount(place, values, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, place, values)
    return out


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The items, read to the driver as far as a block's bytes go, then the next."""
    block, held = Items(), 0
    for row in items.toLocalIterator():
        text = (row[1] or "").encode()
        block.add(row[0], text)
        held += len(text)
        if held >= block_bytes:
            yield block
            block, held = Items(), 0
    if block.ids:
        yield block


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: ``n`` counts all of its terms with
    repeats, ``terms`` are those of the vocabulary, with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            kept, lengths, terms, counts = [], [], [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                n, held = 0, Counter()
                for piece in terms_of(text or b""):
                    n += len(piece)
                    held.update(map(number.get, piece))
                if n:
                    held.pop(None, None)
                    kept.append(row)
                    lengths.append(n)
                    terms.append(list(held))
                    counts.append(list(held.values()))
            ids = batch.column(0).take(pa.array(kept, pa.int64())).cast(id_type)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n long, terms array<int>, tfs array<long>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _searched(vectors: DataFrame, items: Items, k: int, item_type, offset: int) -> DataFrame:
    """Up to ``k`` rows an item from every task: (item_no, item_id, doc_id, score)."""
    spark = vectors.sparkSession
    total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    df = np.zeros(len(items.vocabulary), np.int64)
    # a row for each term of the block's vocabulary at most
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    id_type = vectors.schema["doc_id"].dataType
    schema = f"item_no long, item_id {item_type.simpleString()}, doc_id {id_type.simpleString()}, score long"
    sent = spark.sparkContext.broadcast((Weighted(items, total["n"], total["l"] or 1, df), items.ids))
    kinds = [pa.int64(), to_arrow_type(item_type), to_arrow_type(id_type), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, item_ids = sent.value
        best, held, entries = Best(by.n_items, k), [], 0

        def search() -> None:
            ids = [i for b in held for i in b.column(0).to_pylist()]
            lengths = [n for b in held for n in b.column(1).to_pylist()]
            size = np.concatenate([np.asarray(b.column(2).value_lengths()) for b in held]).astype(np.int64)
            terms, tf = (np.concatenate([np.asarray(b.column(c).flatten()) for b in held]).astype(np.int64) for c in (2, 3))
            search_tree(Tree(ids, lengths, np.concatenate([[0], np.cumsum(size)]), terms, tf, by, k), by, best)

        for batch in batches:
            for part in _cut(batch):
                held.append(part)
                entries += len(part.column(2).flatten())
                if entries >= TREE:
                    search()
                    held, entries = [], 0
        if held:
            search()
        rows = [(offset + x, item_ids[x], r[2], -r[0]) for x, found in enumerate(best.found) for r in found]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["item_no", "item_id", "doc_id", "score"])

    return vectors.filter("size(terms) > 0").select("doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TREE`` entries at most (a document stays whole)."""
    ends, lo = np.cumsum(np.asarray(batch.column(2).value_lengths(), np.int64)), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TREE, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: (item_id, rank, doc_id, score).

    With N documents that hold a term, L terms in them, df documents of a term, tf its count
    in a document of n terms: weight w = floor(1000 ln((2N + 2) / (2 df + 1))),
    m = 25 + 75 n N div L, and the score sums w * (10^9 tf div (1000 tf + 8 m)) over the
    item's terms with repeats. Only scores above 0 are ranked; ties go to the smaller id.

    Items reach the driver and the tasks in blocks of ``block_bytes`` of text; each block is
    one more pass over the documents.
    """
    item_type, id_type = items.schema[item_col].dataType, docs.schema[id_col].dataType
    parts, offset = [], 0
    for block in _blocks(items.select(F.col(item_col), F.col(item_text_col)).distinct(), block_bytes):
        vectors = written(restricted_vectors(docs, block.vocabulary, id_col, text_col), "restricted")
        parts.append(_searched(vectors, block, k, item_type, offset))
        offset += len(block.ids)
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id {id_type.simpleString()}, score long")
    found = reduce(DataFrame.union, parts)
    rank = F.expr("row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id ASC NULLS LAST)")
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
