"""Skew-safe numbering equals a plain row_number window, including when one group
spans many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from lastmile.operators import sequence
from lastmile.operators.sequence import number_within_groups
from lastmile.operators.skew import hot_keys

# (hot_share, sample_fraction, min_sampled_rows): split everything / mixed / defaults
MODES = [
    dict(hot_share=None),
    dict(hot_share=0.05, sample_fraction=1.0, min_sampled_rows=1),
    dict(),
]


def _expected(df, keys, order):
    return df.withColumn("row_num", F.expr(f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize("mode", MODES)
def test_hot_group_split_over_partitions_matches_window(spark, mode):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # one group holds a third of the rows; the rest are small groups
        g = (1, 1) if i % 3 == 0 else (rnd.randint(2, 200), rnd.randint(1, 3))
        rows.append((g[0], g[1], rnd.randint(0, 50), i))
    df = spark.createDataFrame(rows, "a long, b long, t int, v long")
    order = ["t ASC NULLS LAST", "v ASC NULLS LAST"]
    got = number_within_groups(df, ["a", "b"], order, num_partitions=7, **mode)
    assert _rows(got) == _rows(_expected(df, ["a", "b"], order))
    hot = got.filter("a = 1 AND b = 1").agg(F.min("row_num"), F.max("row_num"), F.count("*")).first()
    assert tuple(hot) == (1, 1000, 1000)


@pytest.mark.parametrize("mode", MODES)
def test_null_keys_and_null_order_values(spark, mode):
    rows = [(None, 1), (None, None), (None, 3), (5, None), (5, 2), (5, 2), (6, 1)]
    df = spark.createDataFrame(rows, "k long, t long")
    order = ["t ASC NULLS LAST"]
    got = number_within_groups(df, ["k"], order, num_partitions=3, **mode)
    assert _rows(got) == _rows(_expected(df, ["k"], order))


def test_single_partition_and_empty_input(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 5)], "k long, t long")
    got = number_within_groups(df, ["k"], ["t"], num_partitions=1, hot_share=None)
    assert _rows(got) == [(1, 1, 1), (1, 2, 2), (2, 5, 1)]
    empty = df.filter("k > 10")
    assert number_within_groups(empty, ["k"], ["t"], num_partitions=3).count() == 0
    assert number_within_groups(empty, ["k"], ["t"], num_partitions=3, hot_share=None).count() == 0


def test_equal_rows_of_one_group_spread_over_tasks(spark, monkeypatch):
    """200,000 equal rows of 300,000 in one group: no task holds them all."""
    monkeypatch.setattr(sequence, "CHUNK", 5000)
    equal = spark.range(200_000).selectExpr("1L AS a", "1L AS b", "5L AS t")
    rest = spark.range(100_000).selectExpr("id + 2 AS a", "1L AS b", "id AS t")
    df = equal.unionByName(rest)
    assert hot_keys(df, ["a", "b"], 1e-4) == [(1, 1)]
    got = number_within_groups(df, ["a", "b"], ["t"], num_partitions=8)
    sizes = [r["n"] for r in got.filter("a = 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 6 and max(sizes) <= 80_000
    hot = got.filter("a = 1").agg(F.min("row_num"), F.max("row_num"), F.countDistinct("row_num")).first()
    assert tuple(hot) == (1, 200_000, 200_000) and got.filter("a > 1 AND row_num > 1").isEmpty()


def test_a_hot_first_key_is_dealt_by_all_keys(spark):
    hot = spark.range(60_000).selectExpr("1L AS a", "id DIV 3 AS b", "id AS t")
    rest = spark.range(60_000).selectExpr("id DIV 2 + 2 AS a", "1L AS b", "id AS t")
    df = hot.unionByName(rest).repartition(8, "a")
    got = number_within_groups(df, ["a", "b"], ["t"], num_partitions=8)
    sizes = [r["n"] for r in got.filter("a = 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 60_000 and len(sizes) == 8 and max(sizes) < 12_000
    assert _rows(got) == _rows(_expected(df, ["a", "b"], ["t"]))


def test_hot_key_detection_is_bounded_and_finds_the_hot_group(spark):
    rows = [(1, i) for i in range(4000)] + [(i, 0) for i in range(2, 8002)]
    df = spark.createDataFrame(rows, "k long, t long")
    hot = [k for k, in hot_keys(df, ["k"], hot_share=0.1, sample_fraction=0.2, min_sampled_rows=10)]
    assert hot == [1]
    # at most 1 / hot_share keys can qualify
    assert len(hot_keys(df, ["k"], hot_share=0.25, sample_fraction=1.0, min_sampled_rows=1)) <= 4


def test_default_settings_route_a_hot_group_to_the_split_path(spark):
    hot = spark.range(12000).selectExpr("1L AS a", "1L AS b", "id AS t")
    rest = spark.range(12000).selectExpr("id + 2 AS a", "1L AS b", "id AS t")
    df = hot.unionByName(rest)
    assert hot_keys(df, ["a", "b"], 1e-4, 0.01, 50) == [(1, 1)]
    got = number_within_groups(df, ["a", "b"], ["t"], num_partitions=6)
    assert "Scan ExistingRDD" in got._jdf.queryExecution().executedPlan().toString()  # the checkpoint
    assert _rows(got) == _rows(_expected(df, ["a", "b"], ["t"]))
