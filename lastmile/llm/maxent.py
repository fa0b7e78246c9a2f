"""Language-model scoring with a hashed maximum-entropy model.

Vocabulary: training words counted at least ``MIN_COUNT`` times (the end of a text is one); it
grows with the corpus up to the ``VOCABULARY`` most frequent, which bounds the broadcast. Every
word belongs to a group by its last two bytes, and a group's words outside the vocabulary are
one leaf of it. Classes: a tree over the groups, and in each group one over its leaves, both by
frequency (frequent ones near the root). The model is a class-factored softmax: at each node of
the tree a softmax between its two classes, over hashed features of the history: the word before
and, down to the group, the group before, the two groups before together, and a skip to the
second last group.

    p(word | history) = product over the nodes above it of p(class | node, history)
                        * (c + 1) / (N_group + V_group + 1)     for words outside the vocabulary

where c, N and V are counts over all training texts, so every word of the corpus counts. Without
weights a node's softmax gives the shares of its classes in the corpus.

Corpus counts: documents are dealt to blocks by hash. A block sends its distinct word hashes,
packed, to ``part``s by hash range; a part adds up the blocks' counts and sends each block
the corpus count of its words, in the order in which they came. A frequent word is one entry
a block, so no key is hot; only fixed-size statistics reach the driver.

Training: every partition of training texts runs AdaGrad over mini-batches from the shared
weights; then each weight is averaged over the partitions by its squared slopes there, so that
what few partitions saw isn't thinned: first over a quarter of the texts, then, from there, over
the others. Scoring runs in numpy batches beside the counts of its block.

Defined results: null and empty texts are the end token alone; without training texts all
counts are 0; words are runs of non-blanks with A-Z lower-cased, told apart by 64-bit hashes;
equal rows get equal rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .tokens import LOWERED, HashIndex, Words, constants, mixed, words

VOCABULARY, MIN_COUNT, GROUPS = 1 << 16, 4, 1024
BITS = 20
BUCKETS = 1 << BITS
CHUNKS = 16
TASK_TOKENS = 4_000_000  # training tokens for each copy of the weights that is sent
BLOCK_DOCS = 2048

_U = np.uint64
END = constants(1, 404)[0]
_MIX = constants(8, 405)


# -- tokens -----------------------------------------------------------------------------------


def _endings() -> np.ndarray:
    """The group of every last byte (rows) after every byte before it (0: none)."""
    last, before = LOWERED[:, None].astype(_U), LOWERED[None].astype(_U)
    return (mixed(last * _MIX[6] + before * _MIX[7]) % _U(GROUPS)).astype(np.uint16).ravel()


_GROUP = _endings()


def _groups(part: Words) -> np.ndarray:
    """The group of each word, by its last two bytes."""
    ending = np.take(part.data, part.ends - 1).astype(np.int64) << 8
    ending += np.take(part.data, np.maximum(part.ends - 2, 0)) * (part.ends - part.starts > 1)
    return np.take(_GROUP, ending)


def _tokens(part: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and groups of words with an end after each document's, and the new bounds."""
    at = part.bounds[1:]
    return np.insert(part.hashes(), at, END), np.insert(_groups(part), at, 0), part.bounds + np.arange(len(part.bounds))


# -- corpus counts ----------------------------------------------------------------------------


def _distinct(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct token hashes of a block, ascending, their groups, and where among them each token is."""
    found, which = np.unique(np.concatenate([h for h, _, _ in parts]), return_inverse=True)
    groups = np.empty(len(found), np.uint16)
    groups[which] = np.concatenate([g for _, g, _ in parts])
    return found, groups, which


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


PACK = "block int, part int, hashes binary, counts binary, groups binary"


def _pack(parts: int):
    def run(table: pa.Table) -> pa.Table:
        parts_ = [_tokens(part) for part in words(table.column("text"))]
        found, groups, which = _distinct(parts_)
        lengths = np.concatenate([np.diff(bounds) for _, _, bounds in parts_])
        learn = np.repeat(table.column("train").to_numpy().astype(float), lengths)
        counts = np.bincount(which, learn, len(found)).astype(np.int32)
        part = ((found >> _U(32)) * _U(parts) >> _U(32)).astype(np.int32)
        at = np.searchsorted(part, np.arange(parts + 1))
        rows = [(int(p), _bytes(found[a:b]), _bytes(counts[a:b]), _bytes(groups[a:b])) for p, a, b in zip(range(parts), at[:-1], at[1:]) if b > a]
        part, *binary = zip(*rows)
        block = pa.array([table.column("block")[0].as_py()] * len(rows), pa.int32())
        return pa.table([block, pa.array(part, pa.int32()), *(pa.array(x, pa.binary()) for x in binary)], names=["block", "part", "hashes", "counts", "groups"])

    return run


COUNTED = "block int, part int, counts binary, word long, grp int, n long, v long"


def _count(table: pa.Table) -> pa.Table:
    """Corpus counts back to the blocks; per group its words and tokens; the part's top words."""
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    hashes, groups = join("hashes", _U), join("groups", np.uint16)
    found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    c = np.bincount(inverse, join("counts", np.int32), len(found)).astype(np.int64)
    each = np.cumsum([0] + [len(x) // 8 for x in table.column("hashes").to_pylist()])
    back = c[inverse]
    blocks = table.column("block").to_pylist()
    part = table.column("part")[0].as_py()
    group = groups[first]
    n, v = np.bincount(group, c, GROUPS).astype(np.int64), np.bincount(group[c > 0], minlength=GROUPS)
    top = np.lexsort((found, -c))[:VOCABULARY]
    top = top[c[top] >= MIN_COUNT]
    kinds = {"block": pa.int32(), "part": pa.int32(), "counts": pa.binary(), "word": pa.int64(), "grp": pa.int32(), "n": pa.int64(), "v": pa.int64()}

    def rows(many: int, **columns) -> pa.Table:
        return pa.table([pa.array(columns[k], t) if k in columns else pa.nulls(many, t) for k, t in kinds.items()], names=list(kinds))

    sent = rows(len(blocks), block=blocks, part=[part] * len(blocks), counts=[_bytes(back[s:e]) for s, e in zip(each[:-1], each[1:])])
    stats = rows(GROUPS, part=[part] * GROUPS, grp=np.arange(GROUPS), n=n, v=v)
    return pa.concat_tables([sent, stats, rows(len(top), part=[part] * len(top), word=found[top].view(np.int64), grp=group[top], n=c[top])])


# -- the model --------------------------------------------------------------------------------


def _merged(items: list[tuple[float, int]], parent: np.ndarray, side: np.ndarray, node: int) -> tuple[float, int, int]:
    """The two lightest are made one, again and again: the last one's mass and number, the next node."""
    heap = list(items)
    heapq.heapify(heap)
    while len(heap) > 1:
        a, i = heapq.heappop(heap)
        b, j = heapq.heappop(heap)
        parent[i] = parent[j] = node
        side[j] = 1
        heapq.heappush(heap, (a + b, node))
        node += 1
    return *heap[0], node


class Sent:
    """Arrays that arrive as they were sent.

    An unpickled array has a dtype object of its own, with which ``np.add.at`` leaves its fast
    loop: 240 ns an element instead of 7.
    """

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = {k: x.view(x.dtype.type) if isinstance(x, np.ndarray) else x for k, x in state.items()}


@dataclass
class Tree(Sent):
    """Classes of classes: the nodes above each leaf, and the side it lies on."""

    starts: np.ndarray  # of each leaf's path, and the end
    nodes: np.ndarray
    sides: np.ndarray
    bias: np.ndarray  # of each node: log of the mass on side 1 over that on side 0
    low: int  # nodes from here on are above the groups

    def __post_init__(self) -> None:
        above = np.concatenate([[0], np.cumsum(self.nodes >= self.low)])
        many = np.diff(above[self.starts])
        self.tops = self.starts[1:] - many  # where each path leaves its group
        # above the groups all paths of a group are one, which is read from its first leaf
        _, first, group = np.unique(self.nodes[self.tops] * 2 + self.sides[self.tops], return_index=True, return_inverse=True)
        self.shared = np.stack([self.tops[first], self.starts[first + 1]])[:, group]

    @classmethod
    def of(cls, mass: np.ndarray, group: np.ndarray) -> Tree:
        """From the leaves' masses and groups; every group has a leaf."""
        n = len(mass)
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(GROUPS + 1))
        node, tops = n, []
        for a, b in zip(cuts[:-1], cuts[1:]):
            *top, node = _merged(list(zip(mass[order[a:b]].tolist(), order[a:b].tolist())), parent, side, node)
            tops.append(tuple(top))
        low = node - n
        _merged(tops, parent, side, node)
        root, total, right = 2 * n - 2, np.concatenate([mass, np.zeros(n - 1)]), np.zeros(n - 1)
        depth = np.zeros(2 * n - 1, np.int64)
        for k in range(root):  # children have lower numbers
            total[parent[k]] += total[k]
            right[parent[k] - n] += total[k] * side[k]
        for k in range(root - 1, -1, -1):
            depth[k] = depth[parent[k]] + 1
        starts = np.concatenate([[0], np.cumsum(depth[:n])])
        nodes, sides = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.int8)
        at, live = np.arange(n), np.arange(n)
        for level in range(int(depth[:n].max())):
            nodes[starts[live] + level], sides[starts[live] + level] = parent[at[live]] - n, side[at[live]]
            at[live] = parent[at[live]]
            live = live[at[live] != root]
        return cls(starts, nodes, sides, np.log(right / (total[n:] - right)).astype(np.float32), low)


@dataclass
class Model(Sent):
    """Vocabulary hashes by frequency, the classes, and weights of hashed features."""

    vocabulary: np.ndarray
    tree: Tree
    group_mass: np.ndarray  # log10(N + V + 1) of each group's words outside the vocabulary
    tokens: int
    distinct: int
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.index = HashIndex(10)
        self.index.add(self.vocabulary, np.arange(len(self.vocabulary), dtype=np.int32))
        self.node_hashes = mixed(np.arange(len(self.tree.bias), dtype=_U) * _MIX[0] + _MIX[5])

    def leaves(self, hashes: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The vocabulary's words in order, then the groups."""
        found = self.index.find(hashes)
        return np.where(found >= 0, found, len(self.vocabulary) + groups.astype(np.int32))


def _before(values: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The value ``k`` tokens before, 0 where the text begins."""
    moved = np.zeros_like(values)
    moved[k:] = values[: max(0, len(values) - k)]
    moved[place < k] = 0
    return moved


_ONE, _TWO = (mixed(np.arange(GROUPS + 1, dtype=_U) * _MIX[k]) for k in (1, 3))


def _features(hashes: np.ndarray, groups: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hashes of the features of every token, one row for each."""
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    word, (one, two) = _before(hashes, place, 1), (_before(groups.astype(np.int64) + 1, place, k) for k in (1, 2))
    both = (one << 20 | two).view(_U)
    return np.stack([mixed(word * _MIX[0] + _MIX[4]), np.take(_ONE, one), mixed(both * _MIX[2]), np.take(_TWO, two)])


@dataclass
class Steps:
    """Nodes that some tokens pass, their sides, and the buckets of each feature that counts there."""

    length: np.ndarray  # of each token
    nodes: np.ndarray
    sides: np.ndarray
    buckets: list[np.ndarray]


def _steps(model: Model, begin: np.ndarray, end: np.ndarray, features: np.ndarray) -> Steps:
    length = end - begin
    ends = np.cumsum(length)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(begin - ends + length, length)
    nodes = np.take(model.tree.nodes, at)
    salt = np.take(model.node_hashes, nodes)
    buckets = []
    for f in features:
        b = np.repeat(f, length)
        b ^= salt
        b *= _MIX[7]
        b >>= _U(64 - BITS)
        buckets.append(b.view(np.int64))
    return Steps(length, nodes, np.take(model.tree.sides, at), buckets)


def _paths(model: Model, features: np.ndarray, leaves: np.ndarray) -> tuple[Steps, Steps]:
    """The steps inside the groups, where the first feature counts alone, and those above."""
    tree = model.tree
    own, shared = ([np.take(x, leaves) for x in y] for y in ((tree.starts, tree.tops), tree.shared))
    return _steps(model, *own, features[:1]), _steps(model, *shared, features)


def _logits(model: Model, weights: np.ndarray, steps: Steps) -> np.ndarray:
    x = np.take(model.tree.bias, steps.nodes)
    for b in steps.buckets:
        x += np.take(weights, b)
    return x


CUT = 1 << 11  # tokens whose steps stay in a core's cache


def log_probabilities(model: Model, hashes: np.ndarray, groups: np.ndarray, leaves: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log10 p(leaf | history) of every token."""
    features, out = _features(hashes, groups, bounds), np.zeros(len(leaves))
    for lo in range(0, len(leaves), CUT):
        cut = slice(lo, lo + CUT)
        for steps in _paths(model, features[:, cut], leaves[cut]):
            x = _logits(model, model.weights, steps)
            x *= 1 - 2 * steps.sides  # log(1 + exp(x)) without overflow
            loss = np.log(1 + np.exp(-np.abs(x)))
            loss += np.maximum(x, 0)
            ends = np.cumsum(loss, dtype=float)
            many = np.cumsum(steps.length)
            out[cut] -= np.diff(np.where(many > 0, ends[many - 1], 0.0), prepend=0.0) if len(ends) else 0.0
    return out / np.log(10)


def learn(model: Model, weights: np.ndarray, squares: np.ndarray, hashes: np.ndarray, groups: np.ndarray, leaves: np.ndarray, bounds: np.ndarray, rate: float, batch: int) -> None:
    """AdaGrad steps over mini-batches of tokens."""
    features = _features(hashes, groups, bounds)
    for lo in range(0, len(leaves), batch):
        found = []
        for at in range(lo, min(lo + batch, len(leaves)), CUT):
            cut = slice(at, min(at + CUT, lo + batch))
            for steps in _paths(model, features[:, cut], leaves[cut]):
                x = _logits(model, weights, steps)
                np.negative(x, out=x)
                np.exp(np.minimum(x, 80, out=x), out=x)
                x += 1
                np.divide(1, x, out=x)
                x -= steps.sides
                found.append((x, steps.buckets))
        for k in range(len(features)):
            moved = [(s, b[k]) for s, b in found if k < len(b)]
            for s, b in moved:
                np.add.at(squares, b, s * s)
            for s, b in moved:
                step = s * -rate
                step /= np.sqrt(np.take(squares, b))
                np.add.at(weights, b, step)


UPDATES = "chunk int, weights binary, squares binary"


def _train_partition(sent, rate: float, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        own, squares, seen = model.weights.copy(), np.ones(BUCKETS, np.float32), False
        for records in batches:
            for part in words(records.column(0)):
                hashes, groups, bounds = _tokens(part)
                learn(model, own, squares, hashes, groups, model.leaves(hashes, groups), bounds, rate, batch)
                seen = True
        if seen:
            shares = np.minimum(squares - 1, 60_000).astype(np.float16)
            for k, (w, q) in enumerate(zip(np.array_split(own, CHUNKS), np.array_split(shares, CHUNKS))):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_bytes(w)], pa.binary()), pa.array([_bytes(q)], pa.binary())], names=["chunk", "weights", "squares"])

    return run


def _average(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means by squared slopes; not a number where no partition moved a weight."""
    total, share = 0.0, 0.0
    for records in batches:
        for w, q in zip(records.column("weights"), records.column("squares")):
            q = np.frombuffer(q.as_py(), np.float16).astype(np.float64)
            total, share = total + q * np.frombuffer(w.as_py(), np.float32), share + q
    with np.errstate(invalid="ignore"):
        mean = (total / share).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_bytes(mean)], pa.binary())], names=["chunk", "weights"])


def trained(model: Model, texts: DataFrame, rate: float = 0.2, batch: int = 4096) -> Model:
    """The model after two rounds of distributed updates over ``texts`` (one column)."""
    spark = texts.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-model.tokens // TASK_TOKENS))
    first = F.pmod(F.xxhash64(texts.columns[0]), F.lit(4)) == 0
    for round_ in (texts.filter(first), texts.filter(~first)):
        sent = spark.sparkContext.broadcast(model)
        updates = round_.coalesce(tasks).mapInArrow(_train_partition(sent, rate, batch), UPDATES)
        means = updates.groupBy("chunk").applyInArrow(_average, "chunk int, weights binary").collect()
        if means:
            mean = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(means, key=lambda r: r["chunk"])])
            model = replace(model, weights=np.where(np.isnan(mean), model.weights, mean))
        sent.unpersist()
    return model


def _untrained(counted: DataFrame) -> Model:
    """Vocabulary, classes and their shares, from the counted statistics."""
    stats = counted.filter("word IS NULL AND grp IS NOT NULL").groupBy("grp").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    top = counted.filter("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(VOCABULARY).select("word", "grp", "n").toArrow()
    n, v = np.zeros(GROUPS), np.zeros(GROUPS)
    for r in stats:
        n[r["grp"]], v[r["grp"]] = r["n"], r["v"]
    tokens, distinct = int(n.sum()), int(v.sum())
    word, group, count = (top.column(k).to_numpy() for k in ("word", "grp", "n"))
    n -= np.bincount(group, count, GROUPS)
    v -= np.bincount(group, minlength=GROUPS)
    tree = Tree.of(np.concatenate([count + 1.0, n + v + 1]), np.concatenate([group, np.arange(GROUPS)]))
    return Model(word.view(_U), tree, np.log10(n + v + 1), tokens, distinct, np.zeros(BUCKETS, np.float32))


SCORED = "{id} {id_type}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(sent, id_col: str):
    def run(docs: pa.Table, counted: pa.Table) -> pa.Table:
        model: Model = sent.value
        ids, train, text = docs.column("id").combine_chunks(), docs.column("train").combine_chunks(), docs.column("text")
        if not len(docs):
            return pa.table([ids, train, *(pa.array([], t) for t in (pa.int64(),) * 3 + (pa.float64(),) * 2)], names=names)
        packs = sorted(zip(counted.column("part").to_pylist(), counted.column("counts").to_pylist()))
        corpus = np.frombuffer(b"".join(x for _, x in packs), np.int64)
        parts = [_tokens(part) for part in words(text)]
        found, groups, which = _distinct(parts)
        logs, leaves = np.log10(corpus + 1.0), model.leaves(found, groups)
        inside = np.where(leaves < len(model.vocabulary), 0.0, logs - model.group_mass[groups])
        logs -= np.log10(model.tokens + model.distinct + 1.0)
        out, at = [[] for _ in range(4)], 0
        for hashes, groups, bounds in parts:
            k = which[at : at + len(hashes)]
            at += len(hashes)
            p = log_probabilities(model, hashes, groups, np.take(leaves, k), bounds)
            p += np.take(inside, k)
            for column, values in zip(out, (np.ones(len(k)), np.take(corpus > 0, k), np.take(logs, k), p)):
                column.append(np.add.reduceat(values, bounds[:-1], dtype=float))
        n, known, base, score = (np.concatenate(x) for x in out)
        total = np.full(len(n), model.tokens, np.int64)
        return pa.table([ids, train, *(pa.array(x.astype(np.int64)) for x in (n, known, total)), pa.array(base), pa.array(score)], names=names)

    names = [id_col, "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return run


def lm_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts and log10 probabilities of every text, learnt from those where ``train``.

    ``base_score`` is that of add-one unigrams, ``score`` the model's.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = max(1, -(-rows.count() // BLOCK_DOCS))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks // 4)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    packs = dealt.select("block", "train", "text").groupBy("block").applyInArrow(_pack(parts), PACK)
    counted = written(packs.groupBy("part").applyInArrow(_count, COUNTED), "counts")
    model = trained(_untrained(counted), rows.filter("train").select("text"))
    sent = spark.sparkContext.broadcast(model)
    schema = SCORED.format(id=f"`{id_col}`", id_type=docs.schema[id_col].dataType.simpleString())
    back = counted.filter("block IS NOT NULL").select("block", "part", "counts")
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_score(sent, id_col), schema)
