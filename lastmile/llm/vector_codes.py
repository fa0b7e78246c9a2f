"""Vector code compression: each part of a vector becomes the number of its nearest entry.

A vector's components are scaled to integers and cut into equal consecutive parts, and each
part position has a codebook that is refined in rounds (assign, then replace every entry by
the floored mean of its parts). All arithmetic is on integers, so codes, errors and codebooks
don't depend on how the rows are dealt.

Parts are assigned over a lexicographic trie. The distinct parts of a block of vectors are
sorted, so parts that begin alike share a path, and the distances from a prefix to all entries
are accumulated once for all parts below it: the trie is walked depth first, a child's vector
of distances being its parent's plus one dimension's. Subtries of at most ``LEAVES`` parts are
walked level by level, all their nodes of a depth at once. A leaf takes the nearest entry, and
its part counts with its number of copies.

Vectors stay where they are: a round reads them, sums a row for each entry in every task, and
only those rows are shuffled and added up. The driver holds the codebooks, which are as large
as ``entries`` vectors.

Defined results: rows whose vector is null or holds null or non-finite components are dropped,
as are vectors of another length than that of the smallest id's. Lengths that can't be cut
evenly are filled up with zeros. Scaled components count within a bound at which all squared
distances fit 64 bits (2**27 for 64 dimensions). A repeated id gives one entry of the first
codebook, its lexicographically smallest vector; null ids come last. With fewer ids than
``entries``, codebooks are that small. Other columns may have any name: ``encode`` replaces
those called like its own. An empty table, or one without usable vectors, gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

#: Parts of a subtrie whose nodes are walked level by level.
LEAVES = 256
#: Components (rows x dimensions) of a block of vectors, about.
BLOCK = 1 << 21
#: Labels up to which their sums are broadcast.
LABELS = 100_000


@dataclass
class Codebooks:
    """``centres[part, entry]`` are integer vectors; ``length`` is that of whole vectors."""

    centres: np.ndarray
    length: int
    scale: int

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.centres.ravel().tolist())).encode()).hexdigest()


def bound(length: int) -> int:
    """Largest scaled component: squared distances of whole vectors stay below 2**62."""
    return min(math.isqrt(2**62 // max(length, 1)) // 2, 2**30)


def integers(vectors: pa.Array, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, scaled components) of the usable vectors, by length."""
    sizes = np.asarray(vectors.value_lengths().fill_null(-1), np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls are NaN
    ends = np.cumsum(np.maximum(sizes, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (sizes >= 0) & (bad[ends] == bad[ends - np.maximum(sizes, 0)])
    for length in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == length))
        at = (ends[rows] - length)[:, None] + np.arange(length)
        with np.errstate(over="ignore"):
            scaled = np.floor(flat[at] * scale)
        yield length, rows, np.clip(scaled, -bound(length), bound(length)).astype(np.int64)


def cut(whole: np.ndarray, parts: int) -> np.ndarray:
    """(rows, dimensions) as (parts, rows, dimensions of a part)."""
    size = -(-whole.shape[1] // parts)
    filled = np.pad(whole, ((0, 0), (0, size * parts - whole.shape[1])))
    return np.ascontiguousarray(filled.reshape(len(whole), parts, size).transpose(1, 0, 2))


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows, which of them each row is, and how often each stands."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64), np.array([len(rows)][: len(rows)])
    # big-endian numbers without sign compare like their bytes
    keys = (rows + 2**31).astype(">u4").view(f"V{4 * rows.shape[1]}").ravel()
    _, first, place, copies = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return rows[first], place, copies


def _levels(parts: np.ndarray, depth: int, shared: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances to all entries of sorted distinct parts that share ``depth`` dimensions."""
    opened = np.logical_or.accumulate(parts[1:, depth:] != parts[:-1, depth:], axis=1)
    starts, held = np.zeros(1, np.int64), shared[None, :]
    for j in range(depth, parts.shape[1]):
        nodes = np.concatenate([[0], np.flatnonzero(opened[:, j - depth]) + 1])
        if len(nodes) > len(starts):
            held = held[np.searchsorted(starts, nodes, "right") - 1]
        step = parts[nodes, j][:, None] - centres[:, j]
        step *= step
        held = held + step
        starts = nodes
    return held


def nearest(parts: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (the lowest of equally near ones) and squared distance of sorted distinct parts."""
    n, size = parts.shape
    entry, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not size:
        return entry, far
    most = int(np.abs(parts).max()) + int(np.abs(centres).max())
    kind = np.int32 if most * most * size < 2**31 else np.int64
    parts, centres = parts.astype(kind), centres.astype(kind)
    todo = [(0, n, 0, np.zeros(len(centres), kind))]
    while todo:
        lo, hi, depth, shared = todo.pop()
        if hi - lo <= LEAVES:
            found = _levels(parts[lo:hi], depth, shared, centres)
            entry[lo:hi] = found.argmin(axis=1)
            far[lo:hi] = found[np.arange(hi - lo), entry[lo:hi]]
            continue
        values = parts[lo:hi, depth]
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), hi - lo]
        small, children = 0, []  # neighbours of few parts are walked together
        for x, y in zip(edges, edges[1:]):
            if y - small > LEAVES:
                if x > small:
                    children.append((lo + small, lo + x, depth, shared))
                small = x
            if y - x > LEAVES:
                step = values[x] - centres[:, depth]
                children.append((lo + x, lo + y, depth + 1, shared + step * step))
                small = y
        if small < hi - lo:
            children.append((lo + small, hi, depth, shared))
        todo.extend(reversed(children))
    return entry, far


def _blocks(batches: Iterator[pa.RecordBatch], column: int, length: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(usable rows, their components) of vectors of one length, some rows at a time."""
    for batch in batches:
        rows = max(1, BLOCK // max(length, 1))
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            for size, kept, whole in integers(part.column(column), scale):
                if size == length:
                    yield part.take(pa.array(kept)), whole


def _first_vectors(vectors: DataFrame, id_col: str, vec_col: str, entries: int, scale: int) -> list[list[int]]:
    """Scaled vectors of the ``entries`` smallest ids; all of the smallest id's length.

    Every task hands over ``entries`` rows for each length it has seen, so little is shuffled.
    """
    id_type = vectors.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        last: dict[int, tuple] = {}  # by length, the largest key that can still be among the smallest
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for length, rows, whole in integers(batch.column(1), scale):
                mine = held.setdefault(length, {})
                for row, vector in zip(rows.tolist(), whole):
                    key = (ids[row] is None, ids[row])
                    if length in last and key > last[length]:
                        continue
                    value = tuple(vector.tolist())
                    mine[key] = min(mine.get(key, value), value)
                    if len(mine) >= 2 * entries:
                        kept = sorted(mine)[:entries]
                        held[length] = mine = {k: mine[k] for k in kept}
                        last[length] = kept[-1]
        found = [(length, k[1], list(v)) for length, mine in held.items() for k, v in sorted(mine.items())[:entries]]
        columns = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], arrow_id), pa.array(columns[2], pa.list_(pa.int64()))], names=["size", "id", "vector"]
        )

    rows = vectors.select(F.col(id_col), F.col(vec_col)).mapInArrow(run, f"size int, id {id_type.simpleString()}, vector array<long>")
    by_id = rows.groupBy("size", "id").agg(F.min("vector").alias("vector"))

    def smallest(df: DataFrame) -> list:
        return df.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()

    found = smallest(by_id)
    if len({r["size"] for r in found}) > 1:
        found = smallest(by_id.filter(F.col("size") == found[0]["size"]))
    return [r["vector"] for r in found]


def train(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding"
) -> Codebooks | None:
    """Codebooks after ``rounds`` over all usable vectors; None if there is none."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    first = _first_vectors(vectors, id_col, vec_col, entries, scale)
    if not first:
        return None
    length = len(first[0])
    centres = cut(np.array(first, np.int64).reshape(len(first), length), parts)
    size = centres.shape[2]
    sums = [f"s{j}" for j in range(size)]
    schema = ", ".join(["part int", "entry int", "n long", *(f"{s} long" for s in sums)])
    for _ in range(rounds):
        sent = vectors.sparkSession.sparkContext.broadcast(centres)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            books = sent.value
            count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for _, whole in _blocks(batches, 0, length, scale):
                for p, rows in enumerate(cut(whole, parts)):
                    kinds, _, copies = distinct(rows)
                    entry, _ = nearest(kinds, books[p])
                    order = np.argsort(entry, kind="stable")
                    at = np.flatnonzero(np.diff(entry[order], prepend=-1))
                    used = entry[order][at]
                    count[p, used] += np.add.reduceat(copies[order], at)
                    total[p, used] += np.add.reduceat((kinds * copies[:, None])[order], at)
            p, e = np.nonzero(count)
            columns = [p.astype(np.int32), e.astype(np.int32), count[p, e], *total[p, e].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "n", *sums])

        summed = vectors.select(F.col(vec_col)).mapInArrow(run, schema).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ("n", *sums)))
        centres = centres.copy()
        for r in summed.collect():  # a row for each entry at most
            centres[r["part"], r["entry"]] = np.array(r[3:], np.int64) // r["n"]
        sent.unpersist()
    return Codebooks(centres, length, scale)


def encode(vectors: DataFrame, books: Codebooks, vec_col: str = "embedding", keep: Sequence[str] | None = None) -> DataFrame:
    """The usable vectors' ``keep`` columns (by default all others) with ``code``, two hex
    digits a part, and ``error``, the squared distance to what the code stands for."""
    names = [c for c in (vectors.columns if keep is None else keep) if c.lower() not in (vec_col.lower(), "code", "error")]
    given = vectors.select(*(vectors[f"`{c}`"] for c in names), vectors[f"`{vec_col}`"])
    schema = T.StructType([*(given.schema[c] for c in names), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        digits = np.array([f"{e:02x}" for e in range(256)], "U2")
        for batch, whole in _blocks(batches, len(names), books.length, books.scale):
            error, codes = np.zeros(len(whole), np.int64), []
            for p, rows in enumerate(cut(whole, len(books.centres))):
                kinds, place, _ = distinct(rows)
                entry, far = nearest(kinds, books.centres[p])
                error += far[place]
                codes.append(digits[entry[place]])
            code = ["".join(x) for x in zip(*(c.tolist() for c in codes))]
            columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(code, pa.string()), pa.array(error)], names=[*names, "code", "error"])

    return given.mapInArrow(run, schema)


def compressed(vectors: DataFrame, label_col: str = "label", id_col: str = "vec_id", vec_col: str = "embedding", **training) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every usable vector;
    ``label_error`` sums the errors of equal labels, nulls together.

    The coded rows are written once. The labels' sums, one row each, are broadcast if they
    are ``LABELS`` at most; beyond that they are joined by a shuffle that Spark may split.
    """
    books = train(vectors, id_col=id_col, vec_col=vec_col, **training)
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    if books is None:
        schema = f"`{id_col}` {kinds[id_col]}, `{label_col}` {kinds[label_col]}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    coded = written(encode(vectors, books, vec_col, [id_col, label_col]), "coded")
    sums = written(coded.groupBy(F.col(label_col).alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= LABELS else sums
    joined = coded.join(sums, coded[f"`{label_col}`"].eqNullSafe(sums["of_label"]), "left")
    return joined.select(id_col, label_col, "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
