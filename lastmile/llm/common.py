"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the operators' contracts: space and the code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other code point as it is (``lower`` alone also changes É)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as the text 'null'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % n


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def others(df: DataFrame, *replaced: str) -> list[Column]:
    """The columns of ``df`` apart from those an operator writes itself."""
    drop = {c.lower() for c in replaced}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in drop]


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets its own."""
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="run-shared-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts the lineage and outlives executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compactly_written(df: DataFrame, name: str) -> DataFrame:
    """``written``, for tables much smaller than the texts: two files a core instead of one
    for each shuffle partition, so loops over such tables don't pay for empty tasks."""
    return written(df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism), name)
