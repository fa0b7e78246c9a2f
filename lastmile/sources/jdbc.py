"""JDBC reads and writes for a relational warehouse.

Reads are split into ``num_partitions`` ranges of a numeric column so that one
table is read by many tasks, not one connection; writes batch their inserts.
Connection settings (URL, user, password, driver) always come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BATCH_SIZE = 5000


def read_options(
    url: str,
    table: str,
    connection: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    opts = {**connection, "url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    # Zone-less warehouse timestamps stay zone-less in Spark.
    opts.setdefault("preferTimestampNTZ", "true")
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, connection: Mapping[str, str], **partitioning) -> DataFrame:
    """Read one table; pass ``partition_column`` etc. for a parallel read."""
    return spark.read.format("jdbc").options(**read_options(url, table, connection, **partitioning)).load()


def key_bounds(spark: SparkSession, url: str, table: str, column: str, connection: Mapping[str, str]) -> tuple[int, int]:
    """Min and max of ``column``, computed by the database (one pushed-down row)."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = read_jdbc(spark, url, query, connection).first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def write_options(
    url: str,
    table: str,
    connection: Mapping[str, str],
    batch_size: int = DEFAULT_BATCH_SIZE,
    truncate: bool = False,
) -> dict[str, str]:
    opts = {**connection, "url": url, "dbtable": table, "batchsize": str(batch_size)}
    if truncate:
        # With mode("overwrite"): TRUNCATE ... CASCADE instead of DROP, keeping keys and
        # indexes; a table that others refer to can be emptied only together with them.
        opts.update(truncate="true", cascadeTruncate="true")
    return opts


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    connection: Mapping[str, str],
    mode: str = "append",
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_connections: int | None = None,
) -> None:
    """Append (or truncate-and-load with ``mode="overwrite"``) into a table.

    ``max_connections`` caps concurrent database sessions; the rows are dealt anew for
    it, so the stages before keep their own parallelism.
    """
    out = df if max_connections is None else df.repartition(max_connections)
    opts = write_options(url, table, connection, batch_size, truncate=(mode == "overwrite"))
    out.write.format("jdbc").options(**opts).mode(mode).save()
