"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every byte opens three triplets within its next four bytes. A triplet is hashed to one of
256 buckets; each bucket's count is written as its quartile among the buckets (two bits),
beside the length on a logarithmic scale. Two digests differ by the distance of their
quartiles plus that of their lengths; the score is bounded at what unrelated quartiles give,
so likeness runs from 1 (equal digests) to 0.

Defined results: null and empty texts have the digest of no triplets; texts under four
bytes have few or none and are told apart by length alone; equal texts have equal digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import constants

BUCKETS = 256
#: Mean distance of two independent quartiles (1.25) over all buckets: the score's bound.
FAR = 1.25 * BUCKETS
_LENGTH_BASE = 1.1
_CHUNK = 1 << 20

_TABLES = (constants(4 * 256, 11) >> np.uint64(40)).astype(np.uint8).reshape(4, 256)


def _counts(data: np.ndarray) -> np.ndarray:
    """Triplets by bucket; a long text is read in chunks that share three bytes."""
    total = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(len(data) - 3, 0), _CHUNK):
        part = data[lo : lo + _CHUNK + 3]
        a, b, c = _TABLES[0][part[:-3]], _TABLES[1][part], _TABLES[2][part]
        d = _TABLES[3][part[3:]]
        for bucket in (a ^ b[1:-2] ^ c[2:-1], a ^ b[1:-2] ^ d ^ np.uint8(85), a ^ c[2:-1] ^ d ^ np.uint8(170)):
            total += np.bincount(bucket, minlength=BUCKETS)
    return total


def digest(text: bytes) -> np.ndarray:
    """Length code and the quartile codes (0 to 3) of the buckets, as small numbers."""
    out = np.zeros(BUCKETS + 1, np.int16)
    out[0] = min(255, round(np.log1p(len(text)) / np.log(_LENGTH_BASE)))
    counts = _counts(np.frombuffer(text, np.uint8))
    ranked = np.sort(counts)
    for q in (1, 2, 3):
        out[1:] += counts > ranked[q * BUCKETS // 4 - 1]
    return out


def written_digest(codes: np.ndarray) -> str:
    """Two hex digits of length, then one for each two buckets."""
    pairs = codes[1::2] * 4 + codes[2::2]
    return f"{int(codes[0]):02x}" + "".join("0123456789abcdef"[x] for x in pairs.tolist())


def read_digest(text: str) -> np.ndarray:
    pairs = np.array([int(x, 16) for x in text[2:]], np.int16)
    return np.concatenate([[int(text[:2], 16)], np.stack([pairs >> 2, pairs & 3], 1).ravel()]).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 at or beyond the bound."""
    apart = float(np.abs(a[1:] - b[1:]).sum() + 2 * max(0, abs(int(a[0]) - int(b[0])) - 1))
    return 1.0 - min(1.0, apart / FAR)


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of every whole text in column ``name``."""

    @F.pandas_udf("string")
    def digests(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written_digest(digest((t or "").encode())))

    return docs.withColumn(name, digests(F.coalesce(F.col(text_col), F.lit(""))))


# -- a text and its successor ------------------------------------------------------------------

_LAST = -(2**63)  # where null ids stand in descending order


def _dealt(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(part, key, tail, id, text): runs of descending ids, each followed by its successor.

    Ids are cut at ``n - 1`` quantiles. The successor of a run's last document is the first
    of the next run that has any (of the first run, for the last), so those first rows, one
    id for each run, are copied to the run before. Only ids and run numbers reach the driver.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    ids = docs.select(key.alias("key"))
    cuts = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "left").astype(np.int32))

    firsts = sorted(ids.groupBy(part_of("key").alias("part")).agg(F.max("key").alias("key")).collect(), reverse=True)
    before = {r["key"]: firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parted = rows.withColumn("part", part_of("key"))
    if not before:
        return parted.withColumn("tail", F.lit(False))
    own = F.struct("part", F.lit(False).alias("tail"))

    @F.pandas_udf("int")
    def run_before(keys: pd.Series) -> pd.Series:
        return keys.map(before).astype("Int32")

    copied = F.when(F.col("key").isin(list(before)), F.array(own, F.struct(run_before("key").alias("part"), F.lit(True).alias("tail"))))
    places = F.explode(F.coalesce(copied, F.array(own))).alias("at")
    return parted.select("key", "id", "text", places).select("key", "id", "text", "at.part", "at.tail")


EDITED = "{id_col} long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None) -> DataFrame:
    """Each text's digest beside that of its edited text and of the next document.

    The edited text ends in the first floor(n_chars / 3) code points of the next document by
    descending id (all of them if it has fewer) in place of its own last as many; after the
    last document comes the first. Null ids come last, equal ids in the order of their texts'
    hashes, and a document that is alone follows itself.
    """
    spark = docs.sparkSession
    n = runs or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(docs, id_col, text_col, n)
    ordered = dealt.repartitionByRange(F.col("part")).sortWithinPartitions(F.desc("part"), "tail", F.desc("key"), F.xxhash64("text"))
    names = [id_col, "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = EDITED.format(id_col=f"`{id_col}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = id_ = text = codes = None
        closed = True
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for p, i, t, tail in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "text", "tail"))):
                if p == part and closed:
                    continue  # the other rows of a copied id
                own = digest(t.encode())
                if p == part:
                    k = len(text) // 3
                    edited = text[: len(text) - k] + t[:k] if k else text
                    changed = digest(edited.encode())
                    row = (id_, len(text), edited, written_digest(codes), written_digest(changed), likeness(codes, changed), likeness(codes, own))
                    for column, value in zip(out, row):
                        column.append(value)
                part, id_, text, codes, closed = p, i, t, own, tail
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), *(pa.array(x, pa.string()) for x in out[2:5]), *(pa.array(x, pa.float64()) for x in out[5:])], names=names)

    return ordered.select("part", "tail", "id", "text").mapInArrow(run, schema)
