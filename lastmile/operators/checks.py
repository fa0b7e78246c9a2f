"""Data-quality checks for the warehouse constraints Spark does not enforce.

Every check returns a DataFrame with one row per constraint:
``(table_name, constraint_name, violations)``; ``violations`` is 0 when it holds.
``assert_checks_pass`` turns any violation into an exception.

All checks aggregate before they shuffle, so a key that holds a large share of the
rows is collapsed map-side first.

What can be counted row by row (rows, nulls, ranges) needs no pass of its own when a table is
written: ``observed`` counts it in the writing job, in the very stage that writes, and only
keys and references are left for a look at the written table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lastmile.schemas import TableSpec

CHECK_COLUMNS = ["table_name", "constraint_name", "violations"]
#: Conditions that no row of a table may meet, by constraint.
RANGES = {"order_items": {"range_item_discount_0_1": "item_discount < 0 OR item_discount > 1"}}


def _row(df: DataFrame, table: str, constraint: str, violations: str) -> DataFrame:
    """One result row; ``violations`` is a SQL expression over ``df``."""
    return df.selectExpr(
        f"'{table}' AS table_name",
        f"'{constraint}' AS constraint_name",
        f"CAST(coalesce({violations}, 0) AS BIGINT) AS violations",
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_nonempty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """1 violation for each table without rows."""
    return _union(
        [
            _row(df.selectExpr("count(1) AS n"), name, "non_empty", "CASE WHEN n = 0 THEN 1 ELSE 0 END")
            for name, df in tables.items()
        ]
    )


def check_primary_keys(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Rows whose key is null, plus rows beyond the first for a repeated key."""
    frames = []
    for name, df in tables.items():
        pk = specs[name].pk
        per_key = df.groupBy(pk).agg(F.expr("count(1)").alias("n"))
        excess = per_key.selectExpr(f"sum(CASE WHEN {pk} IS NULL THEN n ELSE n - 1 END) AS v")
        frames.append(_row(excess, name, f"pk_{pk}", "v"))
    return _union(frames)


def check_foreign_keys(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], parents: Mapping[str, DataFrame] | None = None, sieve: bool = False) -> DataFrame:
    """Non-null child key values that have no parent row (rows counted).

    Every child is read once (its key columns stacked and counted per value) and every
    parent once; the constraints whose keys are of one type then meet in one join, the keys
    as they are. ``parents`` are other tables than the children's, if need be.

    ``sieve`` is for few children and large parents: a bit set of ``SIEVE_BITS`` hashed child
    keys, of fixed size, is broadcast to the parents, whose keys are shuffled only if their
    bit is set. It lets some keys through that no child has, never the other way round.
    """
    parents = tables if parents is None else parents
    constraints = [(name, fk, f"fk_{fk.column}_{fk.parent}") for name in tables for fk in specs[name].foreign_keys]
    if not constraints:
        raise ValueError("no foreign keys to check")
    by_type: dict[str, list] = {}
    for c in constraints:
        by_type.setdefault(tables[c[0]].schema[c[1].column].dataType.simpleString(), []).append(c)
    found = [_orphans(of_type, kind, tables, parents, sieve) for kind, of_type in by_type.items()]
    every = ", ".join(f"struct('{name}' AS table_name, '{title}' AS constraint_name)" for name, _, title in constraints)
    spark = next(iter(tables.values())).sparkSession
    none = spark.range(1).selectExpr(f"inline(array({every}))").selectExpr("table_name", "constraint_name", "0L AS n")
    return _union([*found, none]).groupBy("table_name", "constraint_name").agg(F.expr("CAST(sum(n) AS BIGINT)").alias("violations"))


def _orphans(constraints: list, kind: str, tables: Mapping[str, DataFrame], parents: Mapping[str, DataFrame], sieve: bool) -> DataFrame:
    """(table_name, constraint_name, n): child keys of one type without a parent, and their rows."""
    values = []
    for name in dict.fromkeys(name for name, _, _ in constraints):
        mine = [(fk, title) for n, fk, title in constraints if n == name]
        pairs = ", ".join(f"'{name}', '{title}', {fk.column}" for fk, title in mine)
        values.append(tables[name].selectExpr(f"stack({len(mine)}, {pairs}) AS (table_name, constraint_name, value)").filter("value IS NOT NULL"))
    meet = ["table_name", "constraint_name", "value"]
    counted = _union(values).groupBy(*meet).agg(F.expr("count(1)").alias("n"))
    known = []
    for parent, column in sorted({(fk.parent, fk.parent_column) for _, fk, _ in constraints}):
        needed = ", ".join(f"struct('{n}' AS table_name, '{title}' AS constraint_name)" for n, fk, title in constraints if (fk.parent, fk.parent_column) == (parent, column))
        known.append(parents[parent].selectExpr(f"inline(array({needed}))", f"CAST({column} AS {kind}) AS value"))
    known = _union(known)
    if sieve:
        known = sieved(known, counted, meet)
    return counted.join(known, meet, "left_anti").select("table_name", "constraint_name", "n")


#: Bits of the set that child keys are hashed to: two megabytes, in pieces of 32,768 bits.
SIEVE_BITS = 1 << 24


def sieved(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``keys`` hash to a bit that a row of ``wanted`` has set."""
    place = f"pmod(xxhash64({', '.join(keys)}), {SIEVE_BITS})"
    piece, bit = f"{place} DIV 32768", f"CAST({place} % 32768 AS INT)"
    bits = wanted.selectExpr(f"{piece} AS __piece", f"{bit} AS __bit").groupBy("__piece").agg(F.expr("bitmap_construct_agg(__bit)").alias("__bits"))
    placed = df.selectExpr("*", f"{piece} AS __piece", f"{bit} AS __bit")
    byte = "CAST(conv(hex(substring(__bits, __bit DIV 8 + 1, 1)), 16, 10) AS INT)"
    met = placed.join(F.broadcast(bits), "__piece").filter(f"getbit({byte}, __bit % 8) = 1")
    return met.select(*df.columns)


def check_not_null(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Null count of each NOT NULL column, one scan per table."""
    frames = []
    for name, df in tables.items():
        cols = specs[name].not_null
        if not cols:
            continue
        counts = df.selectExpr(*[f"count_if({c} IS NULL) AS {c}" for c in cols])
        frames.append(
            counts.unpivot([], list(cols), "column", "v").selectExpr(
                f"'{name}' AS table_name",
                "concat('not_null_', column) AS constraint_name",
                "CAST(v AS BIGINT) AS violations",
            )
        )
    return _union(frames)


def check_discount_range(order_items: DataFrame) -> DataFrame:
    """Item discounts are fractions: values outside [0, 1] are violations."""
    ((title, outside),) = RANGES["order_items"].items()
    return _row(order_items.selectExpr(f"count_if({outside}) AS v"), "order_items", title, "v")


def observed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Observation]:
    """``df`` to be written, and what will have been counted of it when that is done.

    Nothing may stand between ``observed`` and the write: in the writing stage a partition's
    counts are taken once, however often its task runs.
    """
    seen = Observation(f"{spec.name}-{id(df)}")
    counts = ["count(1) AS `rows`", *(f"count_if({c} IS NULL) AS `not_null_{c}`" for c in spec.not_null)]
    counts += [f"count_if({outside}) AS `{title}`" for title, outside in RANGES.get(spec.name, {}).items()]
    return df.observe(seen, *(F.expr(c) for c in counts)), seen


def observed_violations(spec: TableSpec, counts: Mapping[str, int], nonempty: bool = True) -> list[tuple[str, str, int]]:
    """The checks' rows from what ``observed`` has counted."""
    found = [(spec.name, title, int(n)) for title, n in counts.items() if title != "rows"]
    return [(spec.name, "non_empty", int(counts["rows"] == 0)), *found] if nonempty else found


def as_report(spark: SparkSession, rows: list[tuple[str, str, int]], *frames: DataFrame) -> DataFrame:
    """Counts taken while writing, and those of other checks, as one result."""
    return _union([spark.createDataFrame(rows, "table_name string, constraint_name string, violations long"), *frames])


def check_constraints(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], nonempty: bool = True) -> DataFrame:
    """All constraints of a warehouse: keys, references, NOT NULLs, the discount's range and,
    unless told otherwise, that no table is empty."""
    found = (
        check_primary_keys(tables, specs)
        .unionByName(check_foreign_keys(tables, specs))
        .unionByName(check_not_null(tables, specs))
        .unionByName(check_discount_range(tables["order_items"]))
    )
    return found.unionByName(check_nonempty(tables)) if nonempty else found


def assert_checks_pass(results: DataFrame) -> None:
    """Raise if any constraint has violations. All results are collected, one row for each
    constraint: a filter on them would be planned into every one of their aggregations."""
    assert_counts_pass([tuple(r) for r in results.select(*CHECK_COLUMNS).collect()])


def assert_counts_pass(rows: list[tuple[str, str, int]]) -> None:
    """``assert_checks_pass`` for rows that are at hand."""
    bad = [f"{table}.{constraint}={n}" for table, constraint, n in rows if n > 0]
    if bad:
        raise ValueError(f"Data-quality checks failed: {', '.join(bad)}")
