"""The raw order lake: one wide Parquet table, one row per order item line."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.schemas import RAW

# Partition column of the lake layout written by ``write_raw``: the first day of the
# period (day or month) the row was created in.
CREATED_DATE = "created_date"
GRANULARITIES = ("day", "month")


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal (no session time zone is involved).

    The lake's times are UTC: a bound with a zone, as a scheduler hands them out, is
    converted to UTC first, also when it is given as ISO text.
    """
    if isinstance(value, str):
        try:
            value = dt.datetime.fromisoformat(value)
        except ValueError:
            pass  # left to Spark's parser
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc)
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def slice_filter(start, end, column: str = "created_at") -> Column:
    """Half-open interval ``start <= column < end``; rows with a null time drop out."""
    c = F.col(column)
    return (c >= ts_literal(start)) & (c < ts_literal(end))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Read the lake with the declared schema (no footer inference, no drift).

    Extra partition columns of the layout (``created_date``) stay available for
    pruning but are not part of the row.
    """
    return spark.read.schema(RAW).parquet(path)


def _period(ts: Column, granularity: str) -> Column:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}")
    day = F.to_date(ts)
    return day if granularity == "day" else F.trunc(day, "MM")


def read_raw_slice(spark: SparkSession, path: str, start, end, partitioned: bool = False) -> DataFrame:
    """Rows created in ``[start, end)``. The range filter is pushed into the Parquet
    scan; with the ``created_date`` layout whole period directories are pruned too.

    The pruning is right for either granularity: a directory may hold rows of the slice
    if its date is not before the first day, or is the first of that day's month (where
    a month layout keeps it).
    """
    if not partitioned:
        return read_raw(spark, path).filter(slice_filter(start, end))
    schema = T.StructType(RAW.fields + [T.StructField(CREATED_DATE, T.DateType())])
    period = F.col(CREATED_DATE)
    first, last = F.to_date(ts_literal(start)), F.to_date(ts_literal(end))
    return (
        spark.read.schema(schema)
        .parquet(path)
        .filter(((period >= first) | (period == F.trunc(first, "MM"))) & (period <= last))
        .filter(slice_filter(start, end))
        .drop(CREATED_DATE)
    )


def write_raw(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    granularity: str = "day",
    max_records_per_file: int = 5_000_000,
) -> None:
    """Lay the lake out by creation day (or month) so slices prune to their directories.

    ``rebalance`` clusters rows by day before the write so tasks write few files, and
    adaptive execution splits a day that holds a large share of the rows over several
    tasks instead of one; ``maxRecordsPerFile`` caps file size.
    """
    (
        df.withColumn(CREATED_DATE, _period(F.col("created_at"), granularity))
        .hint("rebalance", CREATED_DATE)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(CREATED_DATE)
        .parquet(path)
    )
