"""Incremental load: extract one time slice and upsert it into the warehouse.

``delta`` applies the normal table builders to the raw rows created in
``[start, end)``. ``merge`` upserts each delta table into its warehouse table on the
primary key, overwriting only the table's updatable columns.

Known contract of the slice keys (kept on purpose): ``order_item_id`` numbers
repeats of an item *within the slice*, so an item seen again in a later slice
reuses ``..._1`` and overwrites the earlier row; rows created outside the slice
are never re-read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame

from lastmile.operators.upsert import upsert
from lastmile.plans.warehouse import BUILDERS, build_all, build_table
from lastmile.schemas import warehouse_table
from lastmile.sources.lake import slice_filter
from lastmile.sources.store import read_table, write_table


def delta_table(raw: DataFrame, name: str, start, end, hot: list | None = None) -> DataFrame:
    """One warehouse table built from the raw rows created in ``[start, end)``; ``hot`` lists
    the orders of very many rows, if the caller knows them."""
    return build_table(raw.filter(slice_filter(start, end)), name, hot)


def delta_tables(raw: DataFrame, start, end) -> dict[str, DataFrame]:
    return build_all(raw.filter(slice_filter(start, end)))


def concurrently(names: Iterable[Any], run: Callable[[Any], Any], at_once: int = 4) -> dict[Any, Any]:
    """``run`` for every name, a few at a time: small tables' jobs don't leave the cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(names)))) as pool:
        return dict(zip(names, pool.map(run, names)))


def stored_deltas(raw: DataFrame, start, end, folder: str) -> dict[str, DataFrame]:
    """The slice's tables, written once under ``folder`` and read from there: a merge reads
    its delta more than once."""
    return stored(delta_tables(raw, start, end), folder)


def stored(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    concurrently(tables, lambda n: write_table(tables[n], folder, n, warehouse_table(n).schema))
    return {n: read_table(t.sparkSession, folder, n, warehouse_table(n).schema) for n, t in tables.items()}


def merge_table(target: DataFrame, delta: DataFrame, name: str, max_broadcast_bytes: int = 0) -> DataFrame:
    """Upsert ``delta`` into ``target`` using the table's key and updatable columns."""
    spec = warehouse_table(name)
    return upsert(target, delta, spec.pk, spec.updatable, max_broadcast_bytes)


def merge_tables(targets: Mapping[str, DataFrame], deltas: Mapping[str, DataFrame], max_broadcast_bytes: int = 0) -> dict[str, DataFrame]:
    return {name: merge_table(targets[name], deltas[name], name, max_broadcast_bytes) for name in BUILDERS}
