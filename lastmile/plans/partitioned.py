"""Warehouse layout whose upserts rewrite only what a slice touches.

The three order-keyed tables (``orders``, ``order_items``, ``order_driver_assignments``) are
kept by ``order_month``, the first day of the month the order was created in (one part, null,
holds the rows without a time). An upsert never changes an order's ``created_at``, and item
and assignment keys contain the order id, so a key never moves between months. A slice
therefore touches only the months of the orders it updates (stored months) and of those it
creates. The four dimensions are kept by ``key_bucket``, a hash of their key; a slice touches
the buckets of its keys. Within a month, files are sorted by order id, or, with ``buckets``,
bucketed by it: read as catalog tables (``lastmile.sources.catalog``) they then join,
aggregate and rank by order without a shuffle.

Nothing is overwritten. A load writes its tables and parts into a folder of its own under
``root/data``, checks them, and then publishes one small manifest that readers resolve
(``lastmile.sources.manifest``). A run that fails at any point before that leaves the
published version as it was, so it is simply run again; readers see the old version or the
new one, never a mix. ``manifest.drain`` deletes what no kept version needs.

The manifest also keeps what later runs would have to read tables for: each month's bounds of
order ids, which tell a slice in what months its orders can be, and the orders that hold very
many rows. What the driver gets is bounded by the calendar and by these parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.operators import checks
from lastmile.operators.skew import default_share, hot_keys
from lastmile.plans.incremental import concurrently, merge_table, stored, stored_deltas
from lastmile.plans.warehouse import build_all
from lastmile.schemas import WAREHOUSE
from lastmile.sources import catalog
from lastmile.sources import manifest as manifests
from lastmile.sources.catalog import BUCKET, MONTH
from lastmile.sources.store import table_path, write_parts

FACTS = ("orders", "order_items", "order_driver_assignments")
DIMENSIONS = tuple(n for n in WAREHOUSE if n not in FACTS)
#: Parts of each dimension.
DIMENSION_BUCKETS = 16
#: Deltas of at most so many bytes are broadcast into their merge.
BROADCAST_BYTES = 64 << 20
#: Orders of very many rows that a manifest lists.
HOT_ORDERS = 10_000
#: Orders whose rows are computed and written at a time, so that shuffle files are a slice's.
ORDERS_AT_ONCE = 2_500_000
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"
_MONTH_OF = "trunc(to_date(created_at), 'MM')"


def _order_months(orders: DataFrame) -> DataFrame:
    return orders.selectExpr("order_id", f"{_MONTH_OF} AS {MONTH}")


def _with_month(name: str, df: DataFrame, months: DataFrame | None) -> DataFrame:
    if name == "orders":
        return df.withColumn(MONTH, F.expr(_MONTH_OF))
    return df.join(months, "order_id", "left").select(*WAREHOUSE[name].columns, MONTH)


def _bucket_of(key: str, n: int) -> Column:
    return F.expr(f"CAST(pmod(xxhash64({key}), {n}) AS INT)")


def order_slices(orders: DataFrame) -> list[str]:
    """Conditions on ``order_id`` that part all rows of any order-keyed table (null ids too)
    into slices of about ``ORDERS_AT_ONCE`` of the given orders; one if they aren't more.

    Slices are ranges: files sorted by order id skip what isn't in them.
    """
    n = math.ceil(orders.count() / ORDERS_AT_ONCE)
    if n < 2:
        return ["true"]
    shares = ", ".join(f"{k / n}D" for k in range(1, n))
    cuts = sorted(set(orders.selectExpr(f"percentile_approx(order_id, array({shares})) AS cuts").first()["cuts"] or []))
    if not cuts:
        return ["true"]
    between = [f"order_id >= {a} AND order_id < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"order_id < {cuts[0]} OR order_id IS NULL", *between, f"order_id >= {cuts[-1]}"]


def _write_tables(
    spark: SparkSession, rows: Callable[[str, str], DataFrame], folder: str, info: dict[str, Any], nonempty: bool
) -> tuple[dict[str, dict[str, str]], list]:
    """Write all seven tables, those that don't need each other at the same time, the two
    large facts by slices of the orders; returns their parts and what was counted of their
    rows on the way. ``rows`` gives a table's rows that meet a condition on the order id."""
    buckets, n = info["buckets"], info["dimension_buckets"]

    def dimension(name: str):
        spec = WAREHOUSE[name]
        return write_parts(rows(name, "true").withColumn(BUCKET, _bucket_of(spec.pk, n)), folder, spec, BUCKET, nonempty=nonempty)

    def fact(name: str, months: DataFrame | None, slices: list[str]):
        dealt = (_with_month(name, rows(name, s), None if months is None else months.filter(s)) for s in slices)
        return write_parts(dealt, folder, WAREHOUSE[name], MONTH, "order_id", buckets, nonempty)

    found = concurrently(DIMENSIONS, dimension)
    found["orders"] = fact("orders", None, ["true"])
    # months come from the orders as written, so both facts agree with them
    orders = _resolved(spark, {"orders": found["orders"][0]}, "orders")
    months, slices = _order_months(orders), order_slices(orders)
    found |= concurrently(FACTS[1:], lambda name: fact(name, months, slices))
    return {n: parts for n, (parts, _) in found.items()}, [r for _, rows in found.values() for r in rows]


def _resolved(spark: SparkSession, paths: dict[str, dict[str, str]], name: str, parts: Iterable[str] | None = None) -> DataFrame:
    """A table, or some parts of it, from its folders."""
    wanted = None if parts is None else set(parts)
    found = [p for part, p in sorted(paths.get(name, {}).items()) if wanted is None or part in wanted]
    schema = WAREHOUSE[name].schema
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read_tables(spark: SparkSession, root: str, database: str | None = None) -> dict[str, DataFrame]:
    """All seven tables of the published version, in their warehouse schema.

    With ``database`` they are its catalog tables, pointed to that version first: tables
    loaded with ``buckets`` are then read bucket by bucket.
    """
    found = manifests.current(spark, root)
    if database:
        catalog.point(spark, database, found.paths)
        return {name: spark.table(f"`{database}`.`{name}`").select(*WAREHOUSE[name].columns) for name in WAREHOUSE}
    return {name: _resolved(spark, found.paths, name) for name in WAREHOUSE}


# -- what a slice touches --------------------------------------------------------------------


def key_ranges(keys: DataFrame, column: str, most: int = 64, cells: int = 1024) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold all (whole-number) keys, with the largest gaps left out.

    The keys' span is cut into ``cells`` cells of one width, and the smallest and largest key
    of each reach the driver.
    """
    ends = keys.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if ends["lo"] is None:
        return []
    width = (ends["hi"] - ends["lo"]) // cells + 1
    cell = F.expr(f"CAST((CAST({column} AS DECIMAL(20,0)) - {ends['lo']}) DIV {width} AS INT)")
    found = keys.filter(f"{column} IS NOT NULL").groupBy(cell.alias("cell")).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
    runs = sorted((r["lo"], r["hi"]) for r in found)
    gaps = sorted(range(1, len(runs)), key=lambda k: runs[k - 1][1] - runs[k][0])[: most - 1]
    cuts = [0, *sorted(gaps), len(runs)]
    return [(runs[a][0], runs[b - 1][1]) for a, b in zip(cuts, cuts[1:])]


def in_ranges(column: str, ranges: Sequence[tuple[int, int]]) -> Column:
    """Whether a key is in one of the ranges; pushed down to the row groups' statistics."""
    if not ranges:
        return F.lit(False)
    return F.expr(" OR ".join(f"({column} >= {lo} AND {column} <= {hi})" for lo, hi in ranges))


def overlapping(bounds: dict[str, list[int]], months: Iterable[str], ranges: Sequence[tuple[int, int]]) -> list[str]:
    """The months whose order ids may lie in the ranges (those of unknown bounds may)."""

    def meets(month: str) -> bool:
        at = bounds.get(month)
        return at is None or any(lo <= at[1] and at[0] <= hi for lo, hi in ranges)

    return [m for m in months if meets(m)]


def month_bounds(spark: SparkSession, parts: dict[str, str]) -> dict[str, list[int]]:
    """Smallest and largest order id of each written month: one pass over that column."""
    if not parts:
        return {}
    base = next(iter(parts.values())).rpartition("/")[0]
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField(MONTH, T.DateType())])
    rows = spark.read.schema(schema).parquet(base).groupBy(MONTH).agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi")).collect()
    return {NULL_MONTH if r[MONTH] is None else r[MONTH].isoformat(): [r["lo"], r["hi"]] for r in rows if r["lo"] is not None}


def stored_orders(spark: SparkSession, published: manifests.Manifest, keys: DataFrame, months: Iterable[str] | None = None) -> DataFrame:
    """The stored orders whose id is among ``keys``.

    Only months whose bounds meet the keys' ranges are opened, and within them the ranges are
    pushed down to row groups, which are sorted by order id.
    """
    ranges = key_ranges(keys, "order_id")
    known = published.paths.get("orders", {}) if months is None else months
    opened = overlapping(published.info.get("bounds", {}).get("orders", {}), known, ranges)
    near = _resolved(spark, published.paths, "orders", opened).filter(in_ranges("order_id", ranges))
    return near.join(keys.select("order_id"), "order_id", "left_semi")


def _month_names(*orders: DataFrame) -> set[str]:
    rows = [r for df in orders for r in df.selectExpr(f"{_MONTH_OF} AS {MONTH}").distinct().collect()]
    return {NULL_MONTH if r[MONTH] is None else r[MONTH].isoformat() for r in rows}


def touched_months(spark: SparkSession, published: manifests.Manifest, delta_orders: DataFrame) -> list[str]:
    """Folder names of the months whose orders a slice updates or may create.

    A known order adds its slice month too, which costs a rewrite at most. The part without
    month, if there is one, is always among them: its rows may get their order now.
    """
    keys = delta_orders.select("order_id")
    months = _month_names(stored_orders(spark, published, keys), delta_orders)
    if any(NULL_MONTH in published.paths.get(n, {}) for n in FACTS):
        months.add(NULL_MONTH)
    return sorted(months)


def touched_buckets(published: manifests.Manifest, name: str, delta: DataFrame) -> list[str]:
    """Names of the dimension's buckets that hold or will hold a key of the slice."""
    if "" in published.paths.get(name, {}):
        return list(published.paths[name])  # the first layout: one part
    rows = delta.select(_bucket_of(WAREHOUSE[name].pk, published.info["dimension_buckets"]).alias("b")).distinct().collect()
    return sorted(str(r["b"]) for r in rows)


# -- checks ----------------------------------------------------------------------------------


def repeated_elsewhere(spark: SparkSession, published: manifests.Manifest, written: dict[str, dict[str, str]], bounds: dict[str, dict]) -> DataFrame | None:
    """Rows of untouched months whose key is in a written month too, counted by table.

    Only untouched months whose order ids overlap the written ones' are opened, within the
    overlapping ranges, and only keys that pass a fixed-size bit set of the written ones are
    shuffled. None if no month overlaps.
    """
    frames = []
    for name in FACTS:
        pk, ranges = WAREHOUSE[name].pk, [tuple(b) for b in bounds[name].values()]
        others = [m for m in published.paths.get(name, {}) if m not in written[name]]
        opened = overlapping(published.info.get("bounds", {}).get(name, {}), others, ranges)
        if opened:
            mine = _resolved(spark, written, name).select(pk)
            theirs = _resolved(spark, published.paths, name, opened).filter(in_ranges("order_id", ranges)).select(pk)
            again = checks.sieved(theirs, mine, [pk]).join(mine, pk, "left_semi")
            frames.append(again.selectExpr(f"'{name}' AS table_name", f"'pk_{pk}_in_other_months' AS constraint_name", "1L AS n"))
    if not frames:
        return None
    found = frames[0]
    for f in frames[1:]:
        found = found.unionByName(f)
    return found.groupBy("table_name", "constraint_name").agg(F.sum("n").alias("violations"))


def _parents(spark: SparkSession, next_version: manifests.Manifest, months: list[str]) -> dict[str, DataFrame]:
    """Whole dimensions, and the orders of the written months (where all of the slice's are)."""
    found = {n: _resolved(spark, next_version.paths, n) for n in DIMENSIONS}
    return found | {"orders": _resolved(spark, next_version.paths, "orders", months)}


# -- loads -----------------------------------------------------------------------------------


def full_load(
    spark: SparkSession, raw: DataFrame, root: str, strict: bool = True, buckets: int = 0, dimension_buckets: int = DIMENSION_BUCKETS
) -> DataFrame:
    """Replace all seven tables; returns the checks' counts.

    ``buckets`` > 0 buckets the facts by order id, the same way in every month: choose it so
    that a bucket of one month is a good file, or, for few months, a bucket a good task. With
    ``strict`` a violated constraint raises before anything is published.
    """
    published = manifests.current(spark, root)
    info: dict[str, Any] = {"buckets": buckets, "dimension_buckets": dimension_buckets, "delta": None, "full": True}
    built = build_all(raw)
    paths, counted = _write_tables(spark, lambda n, some: built[n].filter(some), manifests.new_folder(root), info, nonempty=True)
    tables = {n: _resolved(spark, paths, n) for n in WAREHOUSE}
    report = checks.as_report(spark, counted, checks.check_primary_keys(tables, WAREHOUSE), checks.check_foreign_keys(tables, WAREHOUSE))
    if strict:
        checks.assert_checks_pass(report)
    info["bounds"] = concurrently(FACTS, lambda n: month_bounds(spark, paths[n]))
    info["hot_orders"] = _hot(tables["order_items"], tables["order_driver_assignments"])
    manifests.publish(spark, root, manifests.Manifest(published.version + 1, paths, info))
    return report


def _hot(*facts: DataFrame, known: Sequence[int] = ()) -> list[int]:
    """Orders of very many rows in either fact, those already known first."""
    found = [k for df in facts for (k,) in hot_keys(df.filter("order_id IS NOT NULL"), ["order_id"], default_share(df))]
    return list(dict.fromkeys([*known, *found]))[:HOT_ORDERS]


def incremental_load(
    spark: SparkSession, raw: DataFrame, start, end, root: str, strict: bool = True, max_broadcast_bytes: int = BROADCAST_BYTES,
    raw_read: Callable[[], None] | None = None,
) -> list[str]:
    """Upsert the raw rows created in ``[start, end)``; returns the rewritten months.

    The slice's tables are written once and merged from there. With ``strict`` a violated
    constraint raises before anything is published: single rows and keys in all that is
    written, keys against overlapping months that aren't, references of the slice's rows.
    ``raw_read`` is called when the raw rows are read for the last time.
    """
    folder = manifests.new_folder(root)
    deltas = stored_deltas(raw, start, end, f"{folder}/delta")
    if raw_read:
        raw_read()
    return upsert(spark, deltas, folder, root, strict, max_broadcast_bytes)


def upsert_batch(
    spark: SparkSession, batch: DataFrame, batch_id: int, root: str, stream: str = "incremental-load", strict: bool = True, max_broadcast_bytes: int = BROADCAST_BYTES
) -> list[str]:
    """Upsert one micro-batch of raw rows, once: the manifest that publishes it records its
    number, so a batch that is sent again changes nothing."""
    done = manifests.current(spark, root).info.get("streams", {})
    if batch.isEmpty() or done.get(stream, -1) >= batch_id:
        return []
    folder = manifests.new_folder(root)
    deltas = stored(build_all(batch), f"{folder}/delta")
    return upsert(spark, deltas, folder, root, strict, max_broadcast_bytes, {"streams": done | {stream: batch_id}})


def upsert(
    spark: SparkSession, deltas: dict[str, DataFrame], folder: str, root: str, strict: bool, max_broadcast_bytes: int, more: dict[str, Any] | None = None
) -> list[str]:
    """Merge tables stored under ``folder/delta`` into the published version and publish the
    next one, with ``more`` in its info; returns the rewritten months."""
    published = manifests.current(spark, root)
    if "dimension_buckets" not in published.info:
        published.info |= {"buckets": 0, "dimension_buckets": DIMENSION_BUCKETS}
    months = touched_months(spark, published, deltas["orders"])
    gone = {n: months for n in FACTS} | concurrently(DIMENSIONS, lambda n: touched_buckets(published, n, deltas[n]))

    def merged(name: str, some: str) -> DataFrame:
        # keys contain the order id, so rows that meet are in one slice
        return merge_table(_resolved(spark, published.paths, name, gone[name]).filter(some), deltas[name].filter(some), name, max_broadcast_bytes)

    paths, counted = _write_tables(spark, merged, folder, published.info, nonempty=False)
    written = {n: _resolved(spark, paths, n) for n in WAREHOUSE}
    bounds = concurrently(FACTS, lambda n: month_bounds(spark, paths[n]))
    info: dict[str, Any] = {"delta": f"{folder}/delta", "full": False} | (more or {})
    known = published.info.get("bounds", {})
    info["bounds"] = {n: {m: b for m, b in known.get(n, {}).items() if m not in months} | bounds[n] for n in FACTS}
    info["hot_orders"] = _hot(deltas["order_items"], deltas["order_driver_assignments"], known=published.info.get("hot_orders", []))
    following = published.replaced(paths, gone, info)
    if strict:
        sent = {n: written[n].join(deltas[n].select(WAREHOUSE[n].pk), WAREHOUSE[n].pk, "left_semi") for n in FACTS}
        references = checks.check_foreign_keys(sent, WAREHOUSE, _parents(spark, following, months), sieve=True)
        again = repeated_elsewhere(spark, published, paths, bounds)
        frames = [checks.check_primary_keys(written, WAREHOUSE), references, *([again] if again is not None else [])]
        checks.assert_checks_pass(checks.as_report(spark, counted, *frames))
    manifests.publish(spark, root, following)
    return months
