"""The incremental load as a Structured Streaming query.

New raw Parquet files arriving in the lake are picked up as micro-batches
(``trigger(availableNow=True)`` processes everything new and stops, which is the
scheduled daily run; a processing-time trigger keeps it running). Each micro-batch
goes through the same table builders and upsert as the batch job, inside
``foreachBatch``:

    versions/<batch_id>/<table> = upsert(versions/<batch_id - 1>/<table>, delta(batch))

Batch 0 reads ``initial_root``. A micro-batch that is retried after a failure reads
the same previous version and overwrites its own output, so every batch takes
effect exactly once. Progress is kept in the query's checkpoint, which lives under
the session's shared checkpoint folder unless the caller names one.

``start_partitioned_stream`` is the one for large warehouses: each micro-batch is upserted into
the partitioned layout (``lastmile.plans.partitioned``), rewriting only what it touches, and
the manifest that publishes it records the batch's number, so a retried batch changes nothing.
Old versions go by ``manifest.drain``.

Unlike the time-slice job this selects rows by arrival (new files), not by
``created_at``; rows keep the slice semantics of the builders (``order_item_id``
numbers repeats within one micro-batch).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lastmile.plans import partitioned
from lastmile.plans.incremental import merge_tables, stored
from lastmile.plans.jobs import read_warehouse
from lastmile.plans.warehouse import build_all
from lastmile.schemas import RAW, WAREHOUSE
from lastmile.session import ensure_checkpoint_dir
from lastmile.sources.store import write_table


def version_root(versions_root: str, batch_id: int) -> str:
    return f"{versions_root.rstrip('/')}/{batch_id}"


def _previous(spark: SparkSession, versions_root: str, initial_root: str, batch_id: int) -> dict[str, DataFrame]:
    for b in range(batch_id - 1, -1, -1):
        try:
            tables = read_warehouse(spark, version_root(versions_root, b))
            tables["users"].schema  # resolve the path now
            return tables
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # an empty micro-batch wrote no version
    return read_warehouse(spark, initial_root)


def upsert_batch(batch: DataFrame, batch_id: int, initial_root: str, versions_root: str,
                 max_broadcast_bytes: int = 64 << 20) -> None:
    """``foreachBatch`` body: merge one micro-batch of raw rows into a new version."""
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    current = _previous(spark, versions_root, initial_root, batch_id)
    out = version_root(versions_root, batch_id)
    merged = merge_tables(current, stored(build_all(batch), f"{out}/_delta"), max_broadcast_bytes)
    for name, spec in WAREHOUSE.items():
        write_table(merged[name], out, name, spec.schema)


def start_incremental_stream(
    spark: SparkSession,
    raw_path: str,
    initial_root: str,
    versions_root: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the streaming upsert; returns the running query."""
    location = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-load"
    return _started(spark, raw_path, lambda df, bid: upsert_batch(df, bid, initial_root, versions_root), location, available_now, max_files_per_trigger)


def _started(spark: SparkSession, raw_path: str, body, location: str, available_now: bool, max_files_per_trigger: int | None) -> StreamingQuery:
    reader = spark.readStream.schema(RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(raw_path).writeStream.foreachBatch(body).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def start_partitioned_stream(
    spark: SparkSession,
    raw_path: str,
    root: str,
    name: str = "incremental-load",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    strict: bool = True,
) -> StreamingQuery:
    """Upsert arriving raw files into a partitioned warehouse that a full load has published.

    ``name`` tells this stream's batch numbers from those of others; a new checkpoint needs a
    new name, since its numbers start again.
    """
    location = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"

    def body(batch: DataFrame, batch_id: int) -> None:
        partitioned.upsert_batch(batch.sparkSession, batch, batch_id, root, name, strict)

    return _started(spark, raw_path, body, location, available_now, max_files_per_trigger)
