"""Mart measures and flags on hand-made warehouse rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from lastmile.plans import marts, warehouse
from lastmile.schemas import MART_ORDERS, MART_PRODUCTS


def _shape(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def _tables(make_raw, rows):
    return warehouse.build_all(make_raw(rows))


BASE = {"user_id": 1, "store_id": 3, "created_at": "2000-02-03 04:05:06"}


def test_order_without_items_or_drivers_gets_zeros(make_raw, spark):
    t = _tables(make_raw, [{"order_id": 1, "store_address": "Kazan", "order_discount": 5, **BASE}])
    t["order_items"] = t["order_items"].limit(0)
    m = marts.build_mart("mart_orders", t)
    assert _shape(m.schema) == _shape(MART_ORDERS)
    r = m.first()
    assert r["city"] == "Kazan"  # no comma: whole address
    assert r["total_items_count"] == 0 and r["assigned_driver_count"] == 0
    assert r["items_gross_amount"] == Decimal("0.00")
    assert r["turnover_amount"] == Decimal("-5.00")
    assert (r["order_year"], r["order_month"], r["order_day"]) == (2000, 2, 3)
    assert (r["delivered_order_flag"], r["active_driver_flag"], r["courier_changed_flag"]) == (0, 0, 0)


def test_money_and_flags(make_raw):
    rows = [
        {"order_id": 1, "item_id": 10, "item_quantity": 3, "item_price": "10.50", "item_discount": "0.1",
         "item_canceled_quantity": 1, "driver_id": 7, "delivery_started_at": "2000-02-04 00:00:00",
         "delivered_at": "2000-02-04 02:00:00", "store_address": "Moscow, Tverskaya 1",
         "canceled_at": "2000-02-05 00:00:00", "order_cancellation_reason": "Проблемы с оплатой",
         "delivery_cost": "99.00", "order_discount": 10, "item_title": "t", **BASE},
        {"order_id": 1, "item_id": 11, "item_quantity": 2, "item_price": "1.00", "driver_id": 8,
         "delivery_started_at": "2000-02-04 05:00:00", "item_title": "u", **BASE},
    ]
    t = _tables(make_raw, rows)
    o = marts.build_mart("mart_orders", t).first()
    # gross = 3*10.50 + 2*1 = 33.50; discount = 3.15; turnover = 30.35; canceled = 9.45; paid = 20.90
    assert o["items_gross_amount"] == Decimal("33.50")
    assert o["items_discount_amount"] == Decimal("3.15")
    assert o["items_turnover_amount"] == Decimal("30.35")
    assert o["items_canceled_amount"] == Decimal("9.45")
    assert o["paid_items_amount"] == Decimal("20.90")
    assert o["turnover_amount"] == Decimal("20.35")
    assert o["revenue_amount"] == o["profit_amount"] == Decimal("109.90")
    assert o["city"] == "Moscow"
    assert (o["canceled_after_delivery_flag"], o["service_cancel_flag"], o["courier_changed_flag"]) == (1, 1, 1)
    assert o["assigned_driver_count"] == 2

    p = marts.build_mart("mart_products", t)
    assert _shape(p.schema) == _shape(MART_PRODUCTS)
    by_item = {r["product_id"]: r for r in p.collect()}
    assert by_item[10]["driver_id"] == 7  # first driver by start time
    assert by_item[10]["item_has_cancellation_flag"] == 1 and by_item[11]["item_has_cancellation_flag"] == 0
    assert by_item[10]["revenue_amount"] == Decimal("18.90")
    assert by_item[11]["item_discount"] == Decimal("0.00")


def test_measure_identities_on_fixture(spark):
    from conftest import SF_SMALL

    from lastmile.plans.queries import items_enriched

    df = items_enriched(spark, SF_SMALL)
    bad = df.filter(
        (F.col("gross_amount") != F.col("discount_amount") + F.col("turnover_amount"))
        | (F.col("turnover_amount") != F.col("canceled_amount") + F.col("revenue_amount"))
    ).count()
    assert bad == 0


def test_item_whose_order_is_missing_and_null_address(make_raw):
    rows = [
        {"order_id": 1, "item_id": 10, "item_quantity": 1, "item_price": "2.00", "item_title": "x",
         "store_address": None, **BASE},
        {"order_id": 2, "item_id": 10, "item_quantity": 1, "item_price": "2.00", "item_title": "x", **BASE},
    ]
    t = _tables(make_raw, rows)
    t["orders"] = t["orders"].filter("order_id = 1")  # order 2 is missing
    by_order = {r["order_id"]: r for r in marts.build_mart("mart_products", t).collect()}
    assert by_order[2]["user_id"] is None and by_order[2]["created_order_flag"] == 1
    assert by_order[2]["gross_amount"] == Decimal("2.00")
    assert by_order[1]["city"] is None  # null address


def test_an_order_with_a_third_of_all_items_is_not_gathered(spark):
    """Broadcasts by size off: the hot order's items still spread over the tasks."""
    import datetime as dt

    from pyspark.sql import functions as F

    from lastmile.plans.marts import mart_products
    from lastmile.schemas import WAREHOUSE

    def table(name, rows):
        return spark.createDataFrame(rows, WAREHOUSE[name].schema)

    when = dt.datetime(2000, 1, 1)
    ids = spark.range(90_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1L ELSE 2 + id DIV 9 END AS order_id", "id AS item_id")
    values = {"item_quantity": "1", "item_price": "2.00BD", "item_canceled_quantity": "0", "item_discount": "0BD", "item_replaced_id": "NULL"}
    items = ids.selectExpr("concat(order_id, '_', item_id, '_1') AS order_item_id", "order_id", "item_id", *(f"CAST({v} AS {WAREHOUSE['order_items'].schema[c].dataType.simpleString()}) AS {c}" for c, v in values.items()))
    orders = table("orders", [(i, 1, 1, "x", when, None, None, "card", None, None, None) for i in range(1, 10_003)])
    drivers = table("order_driver_assignments", [(f"{i}_5", i, 5, when, None) for i in range(1, 10_003, 2)])
    stores, products = table("stores", [(1, "Town, x")]), table("products", [(i, f"p{i}", "c") for i in range(0, 90_000, 1000)])
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mart = mart_products(orders, items.repartition(8), drivers, stores, products)
        assert mart.count() == 90_000
        sizes = [r["n"] for r in mart.filter("order_id = 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 8_000
        hot = mart.filter("order_id = 1").agg(F.min("driver_id"), F.max("city"), F.sum("gross_amount")).first()
        assert tuple(hot) == (5, "Town", 60_000)
        assert mart.filter("order_id = 2").select("driver_id").distinct().collect() == [(None,)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
