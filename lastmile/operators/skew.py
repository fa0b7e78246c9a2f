"""Hot keys: found in a sample of the key columns, and kept apart from the others.

A row goes wholly by its key to one path or the other, so what the sample misses costs
balance, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups in which the tasks' sketches are merged before they meet.
MERGED_FIRST = 32


def default_share(df: DataFrame, partitions: int | None = None) -> float:
    """A tenth of one partition's fair share of the rows, at most 1e-4."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(1e-4, 0.1 / n)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_share: float, sample_fraction: float = 0.01, min_sampled_rows: int = 50) -> list:
    """Keys with at least ``hot_share`` of a random sample (and ``min_sampled_rows`` in it).

    One pass over the key columns alone, at planning time. Rows are drawn independently of
    what they hold, so equal rows count as often as others. The sample isn't grouped by key:
    every task counts in a heavy-hitter sketch of a few times ``1 / hot_share`` keys, and the
    sketches, not the keys, are shuffled and merged (in groups, then the groups). Keys above
    the share are always in it; at most ``1 / hot_share`` keys can qualify, and that many
    reach the driver. Counts are estimates, which only cost balance.
    """
    most = math.ceil(1 / hot_share)
    tracked = min(max(4 * most, 64), 1_000_000)
    key = f"to_json(struct({', '.join(f'`{k}`' for k in keys)}), map('ignoreNullFields', 'false'))"
    sampled = df.select(*keys).sample(sample_fraction, seed=7)
    counted = sampled.groupBy(F.expr(f"spark_partition_id() % {MERGED_FIRST}").alias("__group")).agg(
        F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("__sketch"), F.expr("count(1)").alias("__rows")
    )
    # grouped by a constant, so that an empty sample gives no row
    merged = counted.groupBy(F.lit(1)).agg(F.expr(f"approx_top_k_combine(__sketch, {tracked})").alias("__sketch"), F.sum("__rows").alias("__rows"))
    found = merged.select("__rows", F.expr(f"inline(approx_top_k_estimate(__sketch, {most}))"))
    hot = found.filter((F.col("count") >= min_sampled_rows) & (F.col("count") >= hot_share * F.col("__rows")))
    schema = T.StructType([df.schema[k] for k in keys])
    return [tuple(r["key"]) for r in hot.select(F.from_json("item", schema).alias("key"), "count").orderBy(F.desc("count")).collect()]


def key_frame(df: DataFrame, keys: Sequence[str], values: list) -> DataFrame:
    """``values`` as a frame to broadcast: at most ``1 / hot_share`` rows of keys."""
    schema = T.StructType([df.schema[k] for k in keys])
    return F.broadcast(df.sparkSession.createDataFrame(values, schema).alias("__hot"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = left[keys[0]].eqNullSafe(right[keys[0]])
    for k in keys[1:]:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def parted(df: DataFrame, keys: Sequence[str], values: list) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys are among ``values``, and the others."""
    hot = key_frame(df, keys, values)
    cond = same_keys(df, hot, keys)
    return df.join(hot, cond, "left_semi"), df.join(hot, cond, "left_anti")
