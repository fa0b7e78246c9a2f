"""Properties from the test strategy: incremental equals full for dimensions, keys stay
unique after upserts, and top-1 is limited before the shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lastmile.operators import checks
from lastmile.operators.dedupe import first_per_group
from lastmile.plans import warehouse
from lastmile.plans.incremental import delta_tables, merge_tables
from lastmile.plans.queries import SLICE_END, SLICE_START
from lastmile.schemas import WAREHOUSE
from lastmile.sources.lake import ts_literal
from lastmile.sources.testdata import raw_from_tables


@pytest.fixture(scope="module")
def merged(spark):
    raw = raw_from_tables(spark, SF_SMALL)
    base = warehouse.build_all(raw.filter(F.col("created_at") < ts_literal(SLICE_START)))
    return raw, merge_tables(base, delta_tables(raw, SLICE_START, SLICE_END))


@pytest.mark.parametrize("name", ["users", "drivers", "stores", "products"])
def test_incremental_equals_full_for_dimensions(merged, name):
    raw, tables = merged
    full = warehouse.build_table(raw.filter(F.col("created_at") < ts_literal(SLICE_END)), name)
    got = tables[name]
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()


def test_primary_keys_unique_after_upsert(merged):
    _, tables = merged
    result = checks.check_primary_keys(tables, WAREHOUSE)
    assert result.filter("violations > 0").isEmpty()


def test_top1_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS t")
    picked = first_per_group(df, ["k"], ["t DESC NULLS LAST"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("WindowGroupLimit")
    assert "Partial" in plan and plan.rfind("Exchange") < plan.rfind("Partial")
    assert partial >= 0
    assert sorted(r.t for r in picked.collect()) == list(range(993, 1000))
