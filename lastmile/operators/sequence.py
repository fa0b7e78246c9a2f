"""``row_number() over (partition by keys order by ...)`` keeping every row, skew-safe.

A plain window sends every row of a group to one task. That is right for ordinary
groups, and it stays on the JVM with whole-stage codegen. Two kinds of rows leave it:

* **Hot groups**, which hold a large share of the table (``lastmile.operators.skew``
  finds them in a sample of the key columns). They take the split path:
  1. Equal rows are counted together, so a row that is repeated very often is one row
     with a count.
  2. Rows are range-partitioned on ``keys + order`` and sorted; a hot group is cut into
     many consecutive partitions. Each partition numbers its key runs locally, in one
     Arrow pass. The result is checkpointed, so everything that follows sees this one
     partitioning.
  3. Only the first key of a partition can have rows in earlier partitions. A
     per-partition summary (first key, last key, rows of the last key) gives the
     offset for that first key through a running sum. The summary has one row per
     partition and is broadcast, bounded by the partition count.
  4. Counted rows are expanded again in chunks of ``CHUNK`` that are dealt to all tasks.
* **Groups under a hot first key** (very many items of one order). The input is often
  partitioned by that key alone, which satisfies the window and puts all of them in one
  task; these rows are dealt by all keys first.

Without either, the plan is the plain window alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.operators.dedupe import row_number_expr
from lastmile.operators.skew import default_share, hot_keys, parted
from lastmile.session import ensure_checkpoint_dir

# Ship the Arrow task body by value, so executors need numpy/pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Copies of one row that one output chunk of the split path holds.
CHUNK = 10_000

_PART = "__part"
_COPIES = "__copies"
_LOCAL = "__local"
_FIRST = "__first"
_LAST = "__last"
_OFFSET = "__offset"


def _same_as_previous(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """For rows 1..n-1: value equals the previous row's (null equals null)."""
    cur, prev = col.slice(1), col.slice(0, len(col) - 1)
    eq = pc.fill_null(pc.equal(cur, prev), False)
    both_null = pc.and_(pc.is_null(cur), pc.is_null(prev))
    return pc.or_(eq, both_null).to_numpy(zero_copy_only=False)


def _local_numbers(keys: Sequence[str]):
    """mapInArrow body: rows of its key run up to and with each row, copies counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key: tuple | None = None
        last_n = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                yield batch.append_column(_LOCAL, pa.array([], pa.int64()))
                continue
            changed = np.ones(n, dtype=bool)
            if n > 1:
                same = np.ones(n - 1, dtype=bool)
                for k in keys:
                    same &= _same_as_previous(batch.column(k))
                changed[1:] = ~same
            first_key = tuple(batch.column(k)[0].as_py() for k in keys)
            continues = last_key is not None and first_key == last_key
            changed[0] = not continues
            copies = batch.column(_COPIES).to_numpy(zero_copy_only=False)
            total = np.cumsum(copies)
            idx = np.arange(n, dtype=np.int64)
            run_start = np.maximum.accumulate(np.where(changed, idx, 0))
            local = total - (total - copies)[run_start]
            if continues:
                local[run_start == 0] += last_n
            last_key = tuple(batch.column(k)[n - 1].as_py() for k in keys)
            last_n = int(local[-1])
            yield batch.append_column(_LOCAL, pa.array(local, pa.int64()))

    return run


def _sort_item(item: str) -> Column:
    """``"col [ASC|DESC] [NULLS FIRST|LAST]"`` as a sort Column."""
    parts = item.split()
    col = F.expr(parts[0])
    desc = len(parts) > 1 and parts[1].upper() == "DESC"
    nulls = parts[-1].upper() if len(parts) > 2 else ("LAST" if desc else "FIRST")
    if desc:
        return col.desc_nulls_first() if nulls == "FIRST" else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls == "FIRST" else col.asc_nulls_last()


def number_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_num",
    num_partitions: int | None = None,
) -> DataFrame:
    """The split path: numbering that never gathers a group in one task."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Keys ascending with nulls first: the same order Spark uses to compare structs,
    # so min/max of struct(keys) below are a partition's first and last key.
    sort = [_sort_item(f"{k} ASC NULLS FIRST") for k in keys] + [_sort_item(o) for o in order]
    ensure_checkpoint_dir(spark)
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.expr("count(1)").alias(_COPIES))
    ranged = counted.repartitionByRange(n, *sort).sortWithinPartitions(*sort).withColumn(_PART, F.spark_partition_id())
    out_schema = T.StructType(ranged.schema.fields + [T.StructField(_LOCAL, T.LongType(), False)])
    # both branches below must see the same partitions, also when a task runs again
    local = ranged.mapInArrow(_local_numbers(list(keys)), out_schema).checkpoint(eager=True)

    key_list = ", ".join(keys)
    edges = local.groupBy(_PART).agg(
        F.expr(f"min(struct({key_list}))").alias(_FIRST),
        F.expr(f"max(struct({key_list}, {_LOCAL}))").alias(_LAST),
    )
    last_key = "struct(" + ", ".join(f"{_LAST}.{k}" for k in keys) + ")"
    # One row per partition: these windows see at most `n` rows.
    offsets = edges.selectExpr(
        _PART,
        _FIRST,
        f"{last_key} AS __last_key",
        f"sum({_LAST}.{_LOCAL}) OVER (PARTITION BY {last_key} ORDER BY {_PART}) AS __carry",
    ).selectExpr(
        _PART,
        _FIRST,
        f"CASE WHEN lag(__last_key) OVER (ORDER BY {_PART}) <=> {_FIRST} "
        f"THEN lag(__carry) OVER (ORDER BY {_PART}) ELSE 0 END AS {_OFFSET}",
    )
    # the number of a row's last copy, then the chunks of its copies, dealt to all tasks
    last = F.expr(f"{_LOCAL} + CASE WHEN struct({key_list}) <=> {_FIRST} THEN {_OFFSET} ELSE 0 END")
    numbered = local.join(F.broadcast(offsets), _PART, "left").withColumn("__last_number", last)
    chunks = numbered.withColumn("__chunk", F.expr(f"explode(sequence(0L, ({_COPIES} - 1) DIV {CHUNK}))"))
    first = f"__last_number - {_COPIES} + 1 + __chunk * {CHUNK}"
    dealt = chunks.select(*columns, F.expr(first).alias("__from"), F.expr(f"least({first} + {CHUNK - 1}, __last_number)").alias("__to"))
    dealt = dealt.repartition(n, *columns, "__from")
    return dealt.select(*columns, F.expr("explode(sequence(__from, __to))").alias(name))


def number_within_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_num",
    num_partitions: int | None = None,
    hot_share: float | str | None = "auto",
    sample_fraction: float = 0.01,
    min_sampled_rows: int = 50,
    hot_first: list | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... per ``keys`` group in ``order``, keeping all rows.

    ``order`` is a list of SQL sort items and should be total (break ties on every
    kept column); rows that still tie are identical, so which of them gets which
    number cannot be observed. ``hot_share=None`` sends every group down the split
    path. ``"auto"`` flags any group above a tenth of one partition's fair share
    (``min(1e-4, 0.1 / partitions)``), so the hot list is bounded by ten times the
    partition count (or 10,000). A caller that knows the hot first keys gives them as
    ``hot_first``; then nothing is sampled unless there are some.
    """
    if hot_share is None:
        return number_split(df, keys, order, name, num_partitions)
    share = default_share(df, num_partitions) if hot_share == "auto" else hot_share
    keys = list(keys)
    window = F.expr(f"CAST({row_number_expr(keys, order)} AS BIGINT)")
    # what isn't hot by its first key is not hot by all of them
    if hot_first is None:
        hot_first = hot_keys(df, keys[:1], share, sample_fraction, min_sampled_rows)
    if not hot_first:
        return df.withColumn(name, window)
    busy, ordinary = parted(df, keys[:1], hot_first)
    out = ordinary.withColumn(name, window)
    hot = hot_first if len(keys) == 1 else hot_keys(busy, keys, share, sample_fraction, min_sampled_rows)
    if hot:
        group, busy = parted(busy, keys, hot)
        out = out.unionByName(number_split(group, keys, order, name, num_partitions).select(*out.columns))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out if len(keys) == 1 else out.unionByName(busy.repartition(n, *keys).withColumn(name, window))
