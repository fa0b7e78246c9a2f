"""Deterministic "keep one row per key" operators.

Orders are SQL sort items (``"created_at DESC NULLS LAST"``); keys are column names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators.skew import default_share, hot_keys, parted

_RN = "__rn"


def row_number_expr(keys: Sequence[str], order: Sequence[str]) -> str:
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    Written as ``row_number() = 1`` so Catalyst plans a partial ``WindowGroupLimit``
    before the shuffle: every map task forwards at most one row per key, so a key
    holding a large share of the rows never reaches one reducer whole. Callers pass
    an order that is total over the columns they keep, so the result is deterministic.
    """
    return df.withColumn(_RN, F.expr(row_number_expr(keys, order))).filter(f"{_RN} = 1").drop(_RN)


def first_per_spread_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: list | None = None) -> DataFrame:
    """``first_per_group`` for keys whose first one may hold a large share of the rows.

    An input partitioned by the first key alone satisfies the window, so all rows of a hot
    first key would stay in one task. They are found in a sample (or given, where the caller
    knows the ``hot`` first keys) and dealt by all keys.
    """
    hot = hot_keys(df, keys[:1], default_share(df)) if hot is None else hot
    if not hot:
        return first_per_group(df, keys, order)
    busy, ordinary = parted(df, keys[:1], hot)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return first_per_group(ordinary, keys, order).unionByName(first_per_group(busy.repartition(n, *keys), keys, order))


def dedupe_by_key(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per non-null ``key``: its smallest attribute tuple, nulls last.

    Dimension rows repeat once per raw row, so the exact ``distinct`` (hash aggregate
    with map-side combine) first collapses the copies cheaply; the top-1 then only
    sorts the few distinct variants of each key.
    """
    variants = df.filter(f"{key} IS NOT NULL").select(key, *attributes).distinct()
    return first_per_group(variants, [key], [f"{a} ASC NULLS LAST" for a in attributes])
