"""Warehouse and mart tables as Parquet directories under one root."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.functions.conform import conform
from lastmile.operators import checks
from lastmile.schemas import TableSpec
from lastmile.sources.manifest import list_folders


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, name))


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    schema: T.StructType,
    mode: str = "overwrite",
) -> str:
    """Conform ``df`` to ``schema`` and write it; returns the table path.

    ``overwrite`` is the full refresh (truncate + load). Spark cannot overwrite a
    path it is reading in the same job, so an upsert result goes to a new root.
    """
    path = table_path(root, name)
    conform(df, schema).write.mode(mode).parquet(path)
    return path


def write_observed(df: DataFrame, root: str, spec: TableSpec, nonempty: bool = True) -> tuple[str, list[tuple[str, str, int]]]:
    """``write_table`` that also counts what the checks ask of single rows; returns the path
    and those checks' rows."""
    path = table_path(root, spec.name)
    counted, seen = checks.observed(conform(df, spec.schema), spec)
    counted.write.mode("overwrite").parquet(path)
    return path, checks.observed_violations(spec, seen.get, nonempty)


def write_parts(
    df: DataFrame | Iterable[DataFrame], root: str, spec: TableSpec, by: str, sort: str = "", buckets: int = 0, nonempty: bool = True
) -> tuple[dict[str, str], list[tuple[str, str, int]]]:
    """Write a table by the values of its column ``by``; returns the parts' folders and the
    rows of the checks that were counted on the way.

    ``rebalance`` clusters rows by part (and bucket) first, so the number of files follows the
    data, not the tasks, and a part with very many rows is split over several of them. Files
    are sorted by ``sort``; with ``buckets`` they are bucketed by it, which Spark writes only
    as a table, so an external one stands in the catalog as long as that takes.

    A table that comes in slices is written one slice after the other, so what is shuffled at
    a time is a slice, not the table.
    """
    path = table_path(root, spec.name)
    columns = [*spec.columns, by]
    counts: Counter[str] = Counter()
    name, mode, spark = f"lastmile_load_{uuid.uuid4().hex}", "error", None
    try:
        for part in [df] if isinstance(df, DataFrame) else df:
            spark = part.sparkSession
            if buckets:
                bucket = F.expr(f"pmod(hash({sort}), {buckets})")
                dealt = part.withColumn("__bucket", bucket).hint("rebalance", by, "__bucket").select(*columns)
            else:
                dealt = part.select(*columns).hint("rebalance", by)
                dealt = dealt.sortWithinPartitions(by, sort) if sort else dealt
            counted, seen = checks.observed(dealt, spec)
            writer = counted.write.mode(mode).partitionBy(by)
            if buckets:
                writer.format("parquet").bucketBy(buckets, sort).sortBy(sort).option("path", path).saveAsTable(name)
            else:
                writer.parquet(path)
            counts.update(seen.get)
            mode = "append"
    finally:
        if buckets and spark:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    found = [f for f in list_folders(spark, path) if f.startswith(f"{by}=")]
    return {f.partition("=")[2]: f"{path}/{f}" for f in found}, checks.observed_violations(spec, counts, nonempty)
