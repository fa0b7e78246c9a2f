"""Line dedup: lines that stand in many documents go, everywhere.

Main path: DataFrame functions only. Lines are exploded and hashed (two 64-bit hashes with
different first inputs, so 128 bits), distinct documents per hash are counted in two steps
that both combine before they shuffle, and only the lines of common hashes travel back to
their documents, as positions. Texts are split again where they are, so no line text is
shuffled apart from the one join that brings positions to documents.

Hot lines: one line may stand in a third of all documents. Its occurrences are dealt over
``SALTS`` partitions, and the row that says it is common is copied to each of them.

Defined results: null or empty text is one empty line; a text of one common line becomes
empty, with its line counted; null ids are one document (rows with equal id count once, and
rows with equal id and text get equal results); other columns, whatever their names, pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, fresh, others

SALTS = 32


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str = "n_lines",
    dropped_col: str = "n_dropped",
) -> DataFrame:
    """``docs`` with common lines taken out of ``text_col``, plus the two counts.

    A line is common if its key (blanks stripped, A-Z lower-cased) has at least
    ``min_chars`` code points and stands in at least ``min_docs`` different documents.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("of"),
        F.posexplode(F.transform(_lines(F.col(text_col)), _key)).alias("pos", "key"),
    ).filter(F.char_length("key") >= min_chars)
    hashed = rows.select("id", "of", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"))

    common = (
        hashed.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    gone_id, gone_of, gone_at = (fresh(docs, c) for c in ("gone_id", "gone_of", "gone_at"))
    gone = (
        hashed.withColumn("salt", F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int"))
        .join(common, ["h1", "h2", "salt"])
        .groupBy("id", "of").agg(F.collect_set("pos").alias("gone"))
        .select(F.col("id").alias(gone_id), F.col("of").alias(gone_of), F.col("gone").alias(gone_at))
    )

    text = F.coalesce(docs[text_col], F.lit(""))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[gone_id]) & (F.xxhash64(text) == gone[gone_of]), "left")
    lines = _lines(docs[text_col])
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone[gone_at])
    kept = F.when(gone[gone_at].isNull(), text).otherwise(F.array_join(F.transform(kept_at, lambda i: F.get(lines, i)), "\n"))
    n_gone = F.when(gone[gone_at].isNull(), 0).otherwise(F.size(gone[gone_at]))
    return joined.select(
        *others(docs, text_col, lines_col, dropped_col),
        kept.alias(text_col),
        F.size(lines).cast("long").alias(lines_col),
        n_gone.cast("long").alias(dropped_col),
    )
