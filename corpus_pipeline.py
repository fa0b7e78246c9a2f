"""The corpus pipeline: documents in, packed token sequences out, one written table per stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes what a stage returns as
Parquet in the shared folder and gives the written table to the next one. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.llm.common import table, written
from lastmile.llm.language import recognised
from lastmile.llm.line_dedup import drop_common_lines
from lastmile.llm.near_dup import deduplicated
from lastmile.llm.packing import pack
from lastmile.llm.queries import tokenizer_path
from lastmile.llm.tiling import decontaminated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (no letter, no text) go."""
    return recognised(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten or more of the remaining documents go; ``n_chars`` follows."""
    kept = drop_common_lines(docs, min_docs=10, min_chars=1)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return deduplicated(docs, percent=75).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"), min_coverage=0.5, min_tile=3).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences, with their ids (little-endian 32-bit)."""
    pieces = pack(docs, tokenizer_path(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language models, near-duplicate components, tiles and tokens can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
