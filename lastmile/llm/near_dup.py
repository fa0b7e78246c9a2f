"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

1. Each document's distinct five-word shingles are hashed; under each of ``BANDS * ROWS / 2``
   permutations both the minimum and the maximum are kept, so a signature of ``BANDS * ROWS``
   values costs half as many hash evaluations. Bands of ``ROWS`` values are hashed to buckets.
   At the threshold of 0.75 a link shares no bucket with chance (1 - 0.75**4)**32 = 5e-6.
2. Documents of equal sets are one class from here on; copies are never paired.
3. In every bucket one class is the leader and is compared with the others, in two rounds
   with different leaders. The links found give components, and buckets whose classes are all
   in one are done. In the others, every class outside the bucket's largest component is
   compared with all classes of other components there. Every pair in a bucket has then been
   compared or is connected already; none is capped. A bucket of many such pairs is dealt over
   as many portions as its pairs need.
   Before texts are compared, a bound that loses nothing prunes pairs: each set has ``BITS``
   parity bits, and two sets differ in at least as many shingles as in bits.
4. Comparisons are dealt by (leader, portion): a leader of very many comparisons is copied to
   as many portions as it needs, each a run of rows that one task reads in order.

Defined results: words are runs of non-blank characters with A-Z lower-cased; fewer words
than a shingle make one shingle; null, empty and blank texts have no shingles and link with
nothing, and each is its own component; rows of equal id and different text are separate
documents; a null id is in the component of the documents with its text, or has none (then it
links with nothing and is kept); an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import compactly_written, fresh, written
from .components import components
from .tokens import constants, mixed, words

SHINGLE, BANDS, ROWS = 5, 32, 4
BITS = 1024
#: Bits of the set by which texts are chosen before they are joined.
SIEVE = 1 << 24
#: Comparisons of one leader that one portion holds, and pairs of a bucket that one does.
PORTION, PAIRS = 128, 1 << 18

_WORD = constants(SHINGLE + 1, 5)
_PERMUTE = constants(BANDS * ROWS, 6)
_BAND = constants(ROWS, 7)
_U = np.uint64


def shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of documents, ascending in each, and their bounds."""
    n = len(hashes)
    counts = np.diff(bounds)
    per = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per)])
    total = int(out_bounds[-1])
    if not total:
        return np.zeros(0, _U), out_bounds
    start = np.arange(total) + np.repeat(bounds[:-1] - out_bounds[:-1], per)
    length = np.repeat(np.minimum(counts, SHINGLE), per)
    found = length.astype(_U) * _WORD[SHINGLE]
    for k in range(SHINGLE):
        at = np.minimum(start + k, n - 1)
        found += np.where(k < length, hashes[at] * _WORD[k], _U(0))
    found = mixed(found)
    for a, b in zip(out_bounds[:-1], out_bounds[1:]):
        found[a:b].sort()
    new = np.ones(total, bool)
    new[1:] = found[1:] != found[:-1]
    new[out_bounds[:-1][per > 0]] = True
    return found[new], np.concatenate([[0], np.cumsum(new)])[out_bounds]


def _set_names(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each whole set."""
    return mixed(np.add.reduceat(mixed(sets ^ _U(0x5DEECE66D)), starts) + np.diff(np.append(starts, len(sets))).astype(_U))


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Band hashes (one row for each non-empty set) of the min-max signature."""
    half = BANDS * ROWS // 2
    values = np.empty((BANDS * ROWS, len(starts)), _U)
    for k in range(half):
        x = sets * _PERMUTE[k] + _PERMUTE[half + k]
        values[k] = np.minimum.reduceat(x, starts)
        values[half + k] = np.maximum.reduceat(x, starts)
    banded = values.reshape(BANDS, ROWS, -1)
    folded = (banded * _BAND[None, :, None]).sum(1, dtype=_U) + np.arange(BANDS, dtype=_U)[:, None]
    return mixed(folded).T


def parities(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per set, ``BITS`` bits in 64-bit numbers: whether an odd number of hashes fall on each."""
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sets))))
    place = of * BITS + (sets >> _U(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(place, minlength=len(starts) * BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(starts), BITS // 64)


def _lists(values: np.ndarray, full: np.ndarray) -> pa.Array:
    """A list column with a row of ``values`` for each row that is ``full``, else empty."""
    offsets = np.concatenate([[0], np.cumsum(full * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words(batch.column("text")):
            sets, at = shingles(part.hashes(), part.bounds)
            n = np.diff(at)
            full = np.flatnonzero(n)
            names, bands, bits = np.zeros(len(n), np.int64), np.zeros((0, BANDS), _U), np.zeros((0, BITS // 64), np.int64)
            if len(full):
                starts = at[:-1][full]
                names[full] = _set_names(sets, starts).view(np.int64)
                bands, bits = signatures(sets, starts), parities(sets, starts)
            given = [batch.column(c).slice(part.first, len(n)) for c in ("id", "text_hash")]
            columns = [*given, pa.array(n), pa.array(names), _lists(bands, n > 0), _lists(bits, n > 0)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "n", "name", "bands", "bits"])


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lead = None, []
        for batch in batches:
            a, b, leads = (batch.column(k).to_pylist() for k in (0, 1, 2))
            found_a, found_b = [], []
            for part in words(batch.column(3)):
                sets, at = shingles(part.hashes(), part.bounds)
                full = np.flatnonzero(np.diff(at))
                names = np.zeros(len(at) - 1, np.int64)
                if len(full):
                    names[full] = _set_names(sets, at[:-1][full]).view(np.int64)
                for k in range(len(at) - 1):
                    row = part.first + k
                    own = sets[at[k] : at[k + 1]]
                    if leads[row]:
                        if names[k] == a[row]:  # else another text of the same id
                            held, lead = a[row], own.copy()
                    elif names[k] == b[row] and held == a[row]:
                        where = np.searchsorted(lead, own)
                        where[where == len(lead)] = 0
                        shared = int((lead[where] == own).sum())
                        if 100 * shared >= percent * (len(own) + len(lead) - shared):
                            found_a.append(a[row])
                            found_b.append(b[row])
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a leads, b) whose full sets are alike enough."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("b") / PORTION).cast("int").alias("portions"))
    many = compactly_written(many, "leaders")
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("portions")).cast("int").alias("portion"))
    members = dealt.join(texts.withColumnRenamed("name", "b"), "b").select("a", "portion", F.lit(False).alias("leads"), "b", "text")
    leaders = many.select("a", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"))
    leaders = leaders.join(texts.withColumnRenamed("name", "a"), "a").select("a", "portion", F.lit(True).alias("leads"), F.col("a").alias("b"), "text")
    rows = leaders.union(members).repartition("a", "portion").sortWithinPartitions("a", "portion", F.desc("leads"))
    return rows.select("a", "b", "leads", "text").mapInArrow(_compare(percent), "a long, b long")


def _alike(percent: int) -> Column:
    """|a xor b| <= (|a| + |b|) * (100 - p) / (100 + p), with the bits for the left side."""
    differing = sum((F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("bits_a", F.lit(k)))) for k in range(BITS // 64)), F.lit(0))
    return differing * (100 + percent) <= (F.col("n") + F.col("n_a")) * (100 - percent)


def _extended(links: DataFrame | None, pairs: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``links`` and those among ``pairs`` (name, name_a), and the components of all."""
    pairs = pairs.groupBy(F.least("name", "name_a").alias("lo"), F.greatest("name", "name_a").alias("hi")).agg(F.min("name_a").alias("a"))
    b = F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b")
    found = written(_links(compactly_written(pairs.select("a", b), "pairs"), texts, percent), "found")
    links = found if links is None else links.union(found)
    return links, components(links)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their new labels, of buckets that hold more than one component."""
    now = members.drop("label").join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn("label", F.coalesce("label", "name"))
    several = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("bucket")
    return written(now.join(written(several, "open"), "bucket"), "buckets")


def _sieve(ids: DataFrame, column: str):
    """A test that every id of ``ids`` passes, and most others don't: one hash into a bit set
    of fixed size (2 MB, whatever the number of ids), so the texts of other ids stay put."""
    spot = F.pmod(F.xxhash64(column), F.lit(SIEVE)).cast("long")
    filled = ids.select(spot.alias("spot")).groupBy(F.expr("spot DIV 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(spot % 64 AS INT)))").alias("bits")).toPandas()
    bits = np.zeros(SIEVE // 64, np.int64)
    bits[filled["at"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64)
    sent = ids.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def passes(spots: pd.Series) -> pd.Series:
        at = spots.to_numpy(np.int64)
        return pd.Series((sent.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return passes(spot)


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash, group) for every row of ``docs``.

    ``group`` is a hash that names the component of the row's text. Two documents link if their sets' intersection is at least ``percent`` of their union.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashed = given.withColumn("text_hash", F.xxhash64("text"))
    signed = written(hashed.mapInArrow(_sign, f"id {id_type}, text_hash long, n long, name long, bands array<long>, bits array<long>"), "signatures")
    classes = written(signed.filter("n > 0").groupBy("name").agg(F.min("id").alias("least"), F.first("n").alias("n")), "classes")

    first = classes.select("name", F.col("least").alias("id"))
    # of repeated rows one, on the join's own partitioning
    once = signed.select("name", "id", "n", "bands").join(first, ["name", "id"]).dropDuplicates(["name", "id"])
    band_rows = once.select(F.explode("bands").alias("bucket"), "name", "n")
    shared = band_rows.groupBy("bucket").agg(F.min("name").alias("x"), F.max("name").alias("y")).filter("x < y").select("bucket")
    members = written(band_rows.join(written(shared, "shared"), "bucket"), "buckets")

    # bits and texts of the classes that meet another one, under their least id
    met = members.select("name").distinct()
    wanted = written(met.join(classes, "name").select("name", F.col("least").alias("id")), "wanted")
    bits = written(signed.select("name", "id", "bits").join(wanted, ["name", "id"]).dropDuplicates(["name"]).select("name", "bits"), "bits")
    some = given.filter(F.col("id").isNotNull() & _sieve(wanted, "id"))
    texts = written(some.join(wanted, "id").select("name", "text").distinct(), "texts")
    left, right = bits, bits.select(F.col("name").alias("name_a"), F.col("bits").alias("bits_a"))

    links = labels = None
    members = members.withColumn("label", F.col("name"))
    sizes_fit = F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent
    for lead in (F.min, F.max):
        leaders = members.groupBy("bucket").agg(lead(F.struct("name", "n", "label")).alias("lead"))
        leaders = written(leaders.select("bucket", *(F.col(f"lead.{c}").alias(f"{c}_a") for c in ("name", "n", "label"))), "leaders")
        pairs = members.join(leaders, "bucket").filter((F.col("label") != F.col("label_a")) & sizes_fit).select("name", "name_a", "n", "n_a").distinct()
        pairs = written(pairs, "pairs").join(left, "name").join(right, "name_a").filter(_alike(percent))
        links, labels = _extended(links, pairs, texts, percent)
        members = _open(members, labels)
        if members.isEmpty():
            break
    else:
        sizes = members.groupBy("bucket", "label").agg(F.count("name").alias("k"))
        sizes = sizes.groupBy("bucket").agg(F.sum("k").alias("all"), F.max(F.struct("k", "label")).alias("main"))
        portions = F.ceil((F.col("all") - F.col("main.k")) * F.col("all") / PAIRS).cast("int")
        sizes = written(sizes.select("bucket", F.col("main.label").alias("main"), portions.alias("portions")), "sizes")
        dealt = written(members.join(sizes, "bucket").join(left, "name"), "members")
        outside = dealt.filter("label <> main").withColumn("portion", F.pmod(F.xxhash64("name"), F.col("portions")).cast("int"))
        outside = outside.select("bucket", "portion", *(F.col(c).alias(f"{c}_a") for c in ("name", "n", "label", "bits")))
        everyone = dealt.withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
        pairs = everyone.join(outside, ["bucket", "portion"]).filter((F.col("label") != F.col("label_a")) & sizes_fit & _alike(percent))
        links, labels = _extended(links, pairs, texts, percent)

    named = classes.withColumn("group", F.col("name"))
    if labels is not None:
        named = classes.join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn("group", F.coalesce("label", "name"))
    least = named.groupBy("group").agg(F.min("least").alias("component"))
    named = written(named.select("name", "group").join(least, "group"), "components")
    joined = signed.select("id", "text_hash", "n", "name").join(named, "name", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    kept = component.isNull() | F.coalesce(F.col("id") == component, F.lit(False))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), "text_hash", "group")


def deduplicated(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: that of the least id.

    Of repeated rows one stays, and of an id's different texts in one component that whose
    hash is least.
    """
    found = near_duplicates(docs, percent, id_col, text_col).filter("kept")
    group = F.coalesce("group", "text_hash").alias("of")  # texts without words stand alone
    least = found.groupBy(id_col, group).agg(F.min("text_hash").alias("hash"))
    kept_id, kept_hash, own_hash = (fresh(docs, c) for c in ("kept_id", "kept_hash", "own_hash"))
    kept = written(least.select(F.col(id_col).alias(kept_id), F.col("hash").alias(kept_hash)), "kept")
    hashed = docs.withColumn(own_hash, F.xxhash64(F.col(text_col)))
    same = hashed[id_col].eqNullSafe(kept[kept_id]) & (hashed[own_hash] == kept[kept_hash])
    return hashed.join(kept, same, "left_semi").dropDuplicates([id_col, own_hash]).drop(own_hash)
