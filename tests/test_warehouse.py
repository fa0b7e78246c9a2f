"""Normalisation rules on hand-made raw rows (cases the derived fixture cannot reach)."""

import pytest

from lastmile.plans import warehouse
from lastmile.plans.incremental import delta_table, merge_table


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimensions_drop_null_keys_and_pick_deterministically(make_raw):
    raw = make_raw(
        [
            {"user_id": 1, "user_phone": "b"},
            {"user_id": 1, "user_phone": "a"},
            {"user_id": 1, "user_phone": None},
            {"user_id": None, "user_phone": "z"},
            {"user_id": 2, "user_phone": None},
        ]
    )
    assert _rows(warehouse.users(raw)) == [(1, "a"), (2, None)]


def test_orders_keep_latest_version_nulls_last(make_raw):
    raw = make_raw(
        [
            {"order_id": 7, "user_id": 1, "store_id": 1, "created_at": "2000-01-01 00:00:00", "payment_type": "old"},
            {"order_id": 7, "user_id": 1, "store_id": 1, "created_at": "2000-01-05 00:00:00", "payment_type": "new"},
            {"order_id": 7, "user_id": 1, "store_id": 1, "created_at": None, "payment_type": "null-ts"},
            {"order_id": None, "created_at": "2001-01-01 00:00:00"},
        ]
    )
    got = warehouse.orders(raw).collect()
    assert len(got) == 1 and got[0]["payment_type"] == "new"


def test_order_items_number_repeats_by_created_at(make_raw):
    raw = make_raw(
        [
            {"order_id": 1, "item_id": 5, "created_at": "2000-01-02 00:00:00", "item_quantity": 2},
            {"order_id": 1, "item_id": 5, "created_at": "2000-01-01 00:00:00", "item_quantity": 1},
            {"order_id": 1, "item_id": 6, "created_at": "2000-01-03 00:00:00", "item_quantity": 3},
            {"order_id": 1, "item_id": None, "created_at": "2000-01-03 00:00:00"},
        ]
    )
    got = {r["order_item_id"]: r["item_quantity"] for r in warehouse.order_items(raw).collect()}
    assert got == {"1_5_1": 1, "1_5_2": 2, "1_6_1": 3}


def test_assignment_key_without_start(make_raw):
    raw = make_raw(
        [
            {"order_id": 1, "driver_id": 9, "created_at": "2000-01-01 00:00:00", "delivered_at": None},
            {"order_id": 1, "driver_id": 9, "created_at": "2000-01-02 00:00:00",
             "delivered_at": "2000-01-03 00:00:00"},
            {"order_id": 1, "driver_id": 9, "created_at": "2000-01-02 00:00:00",
             "delivery_started_at": "2000-01-02 10:30:00"},
            {"order_id": 1, "driver_id": None, "created_at": "2000-01-02 00:00:00"},
        ]
    )
    got = {r["assignment_id"]: r["delivered_at"] for r in warehouse.order_driver_assignments(raw).collect()}
    assert set(got) == {"1_9_no_start", "1_9_2000-01-02 10:30:00"}
    assert got["1_9_no_start"] is not None  # latest raw row wins


def test_unknown_table_name(make_raw):
    with pytest.raises(ValueError):
        warehouse.build_table(make_raw([{"order_id": 1}]), "payments")


def test_row_num_restarts_in_each_slice(make_raw):
    """Documented contract: a repeat seen in a later slice reuses ``_1`` and overwrites."""
    raw = make_raw(
        [
            {"order_id": 1, "item_id": 5, "created_at": "1999-12-30 00:00:00", "item_quantity": 1},
            {"order_id": 1, "item_id": 5, "created_at": "2000-01-02 00:00:00", "item_quantity": 4},
        ]
    )
    base = warehouse.order_items(raw.filter("created_at < '2000-01-01'"))
    delta = delta_table(raw, "order_items", "2000-01-01", "2000-02-01")
    merged = merge_table(base, delta, "order_items")
    assert [(r["order_item_id"], r["item_quantity"]) for r in merged.collect()] == [("1_5_1", 4)]
    # the full load keeps both rows
    assert sorted(r["order_item_id"] for r in warehouse.order_items(raw).collect()) == ["1_5_1", "1_5_2"]


def test_upsert_keeps_created_at_and_overwrites_with_null(make_raw):
    raw = make_raw(
        [
            {"order_id": 1, "user_id": 1, "store_id": 1, "created_at": "1999-12-01 00:00:00",
             "paid_at": "1999-12-01 01:00:00", "delivery_cost": "10.00"},
            {"order_id": 1, "user_id": 2, "store_id": 1, "created_at": "2000-01-05 00:00:00",
             "paid_at": None, "delivery_cost": "12.50"},
        ]
    )
    base = warehouse.orders(raw.filter("created_at < '2000-01-01'"))
    delta = delta_table(raw, "orders", "2000-01-01", "2000-02-01")
    r = merge_table(base, delta, "orders").first()
    assert str(r["created_at"]) == "1999-12-01 00:00:00"  # not updatable
    assert r["user_id"] == 1  # not updatable
    assert r["paid_at"] is None  # EXCLUDED null overwrites
    assert str(r["delivery_cost"]) == "12.50"


def test_hot_order_item_group_through_the_builder(spark):
    """One (order, item) group with 8,000 rows and one store holding most orders: the
    builder routes the group to the split path and numbers it like a plain window."""
    from pyspark.sql import functions as F

    from lastmile.plans.warehouse import order_items
    from lastmile.schemas import RAW

    hot = spark.range(8000).select(
        F.lit(1).cast("long").alias("order_id"),
        F.lit(5).cast("long").alias("item_id"),
        F.lit(1).cast("long").alias("store_id"),
        F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("created_at"),
        (F.col("id") % 7).cast("int").alias("item_quantity"),
    )
    rest = spark.range(3000).select(
        (F.col("id") + 2).alias("order_id"),
        (F.col("id") % 11).alias("item_id"),
        F.lit(1).cast("long").alias("store_id"),
        F.expr("timestamp_ntz'2000-01-01 00:00:00'").alias("created_at"),
        F.lit(1).alias("item_quantity"),
    )
    rows = hot.unionByName(rest)
    raw = rows.select([
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW.fields
    ])
    got = order_items(raw)
    assert "Scan ExistingRDD" in got._jdf.queryExecution().executedPlan().toString()
    hot_rows = got.filter("order_id = 1").select("order_item_id", "item_quantity").collect()
    assert len(hot_rows) == 8000
    # numbering follows created_at (one second apart), so n = seconds + 1
    expected = raw.filter("order_id = 1").selectExpr(
        "concat_ws('_', order_id, item_id, row_number() OVER (ORDER BY created_at)) AS order_item_id",
        "item_quantity",
    )
    assert sorted(map(tuple, hot_rows)) == sorted(map(tuple, expected.collect()))
    assert got.count() == 11000
