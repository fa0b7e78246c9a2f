"""The three batch jobs: full load, incremental load and mart build.

Each job reads its inputs, writes its outputs as Parquet table directories and
validates them from the written data (never by recomputing the plan). Table roots
are caller-supplied shared paths; nothing is kept on one machine.

* ``full_load``        raw lake -> seven warehouse tables (truncate + load)
* ``incremental_load`` one raw slice upserted into the warehouse -> a *new* root
                       (Spark cannot overwrite a table it is reading in the same job)
* ``build_marts``      warehouse tables -> two marts
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lastmile.functions.conform import conform
from lastmile.operators import checks
from lastmile.plans import marts
from lastmile.plans.incremental import concurrently, merge_tables, stored_deltas
from lastmile.plans.warehouse import build_all
from lastmile.schemas import MARTS, WAREHOUSE
from lastmile.sources import jdbc
from lastmile.sources.store import read_table, write_observed, write_table

MART_INPUTS = ("orders", "order_items", "order_driver_assignments", "stores", "products")

# Write order: the four dimensions together, then orders, then the two facts together.
LOAD_STAGES = (
    ("users", "drivers", "stores", "products"),
    ("orders",),
    ("order_items", "order_driver_assignments"),
)


def read_warehouse(spark: SparkSession, root: str, names=tuple(WAREHOUSE)) -> dict[str, DataFrame]:
    return {n: read_table(spark, root, n, WAREHOUSE[n].schema) for n in names}


def validate_warehouse(spark: SparkSession, root: str, strict: bool = True, nonempty: bool = True) -> DataFrame:
    """All constraints on the written tables, as counts; ``strict`` raises if one is violated."""
    result = checks.check_constraints(read_warehouse(spark, root), WAREHOUSE, nonempty)
    if strict:
        checks.assert_checks_pass(result)
    return result


def _write_all(tables: dict[str, DataFrame], root: str, strict: bool) -> dict[str, str]:
    """Write the seven tables stage by stage, those of one stage as concurrent Spark jobs.

    ``strict`` raises if a constraint is violated. Single rows are counted while a table is
    written; its keys and references (to tables of the stages before) are looked at as soon
    as it stands, beside the other tables' writes.
    """

    def load(name: str) -> tuple[str, list]:
        spark, spec = tables[name].sparkSession, WAREHOUSE[name]
        path, counted = write_observed(tables[name], root, spec)
        if strict:
            written = read_warehouse(spark, root, [name, *dict.fromkeys(fk.parent for fk in spec.foreign_keys)])
            frames = [checks.check_primary_keys({name: written[name]}, WAREHOUSE)]
            if spec.foreign_keys:
                frames.append(checks.check_foreign_keys({name: written[name]}, WAREHOUSE, written))
            counted = counted + [r for rows in concurrently(range(len(frames)), lambda k: frames[k].collect()).values() for r in map(tuple, rows)]
        return path, counted

    found: dict[str, tuple[str, list]] = {}
    for stage in LOAD_STAGES:
        found |= concurrently(stage, load)
    if strict:
        checks.assert_counts_pass([r for _, rows in found.values() for r in rows])
    return {n: path for n, (path, _) in found.items()}


def full_load(spark: SparkSession, raw: DataFrame, warehouse_root: str, strict: bool = True) -> dict[str, str]:
    """Replace all seven tables with the normalised ``raw`` rows.

    ``strict`` fails if a table is empty or breaks a key, reference or NOT NULL;
    otherwise ``validate_warehouse(..., strict=False)`` returns the counts.
    """
    return _write_all(build_all(raw), warehouse_root, strict)


def incremental_load(
    spark: SparkSession,
    raw: DataFrame,
    start,
    end,
    current_root: str,
    new_root: str,
    strict: bool = True,
    max_broadcast_bytes: int = 64 << 20,
) -> dict[str, str]:
    """Upsert the raw rows created in ``[start, end)`` into the tables at
    ``current_root`` and write the merged tables to ``new_root``.

    The slice's tables are written once, under ``new_root/_delta``, and merged from
    there. ``strict`` fails if the merged tables break a constraint; ``current_root`` is
    never changed. Re-running the same slice on the same ``current_root`` gives the same result, so
    a failed run is simply repeated.
    """
    if current_root.rstrip("/") == new_root.rstrip("/"):
        raise ValueError("new_root must differ from current_root")
    deltas = stored_deltas(raw, start, end, f"{new_root.rstrip('/')}/_delta")
    merged = merge_tables(read_warehouse(spark, current_root), deltas, max_broadcast_bytes)
    return _write_all(merged, new_root, strict)


def build_marts(spark: SparkSession, warehouse_root: str, mart_root: str) -> dict[str, str]:
    """Rebuild both marts from the warehouse; fail if either is empty."""
    tables = read_warehouse(spark, warehouse_root, MART_INPUTS)
    paths = concurrently(MARTS, lambda name: write_table(marts.build_mart(name, tables), mart_root, name, MARTS[name]))
    written = {name: read_table(spark, mart_root, name) for name in MARTS}
    checks.assert_checks_pass(checks.check_nonempty(written))
    return paths


def full_load_jdbc(
    spark: SparkSession, raw: DataFrame, staging_root: str, url: str, connection: Mapping[str, str], schema: str = "dwh", max_connections: int = 8
) -> None:
    """The full load into a database the caller names.

    The tables are written and checked under ``staging_root`` first, and each is loaded
    from there. Parents go first: truncating one empties its children too, which are
    loaded after it.
    """
    full_load(spark, raw, staging_root)
    tables = read_warehouse(spark, staging_root)
    for name in (n for stage in LOAD_STAGES for n in stage):
        jdbc.write_jdbc(tables[name], url, f"{schema}.{name}", connection, mode="overwrite", max_connections=max_connections)


def build_marts_jdbc(
    spark: SparkSession, mart_root: str, url: str, connection: Mapping[str, str], schema: str = "dwh", mart_schema: str = "mart", connections: int = 8
) -> None:
    """Both marts from database tables, back into the database, by way of ``mart_root``.

    Order-keyed tables are read in ``connections`` ranges of their order id; the marts
    are written as Parquet once, so a failed insert doesn't read or join again.
    """
    tables = {}
    for name in MART_INPUTS:
        parts = {}
        if "order_id" in WAREHOUSE[name].columns:
            low, high = jdbc.key_bounds(spark, url, f"{schema}.{name}", "order_id", connection)
            parts = {"partition_column": "order_id", "lower_bound": low, "upper_bound": high + 1, "num_partitions": connections}
        tables[name] = conform(jdbc.read_jdbc(spark, url, f"{schema}.{name}", connection, **parts), WAREHOUSE[name].schema)
    for name, table_schema in MARTS.items():
        write_table(marts.build_mart(name, tables), mart_root, name, table_schema)
    written = {name: read_table(spark, mart_root, name, table_schema) for name, table_schema in MARTS.items()}
    checks.assert_checks_pass(checks.check_nonempty(written))
    for name, df in written.items():
        jdbc.write_jdbc(df, url, f"{mart_schema}.{name}", connection, mode="overwrite", max_connections=connections)
