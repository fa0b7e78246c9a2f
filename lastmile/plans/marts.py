"""The two data marts and their intermediate steps.

Inputs are the warehouse tables (``orders``, ``order_items``,
``order_driver_assignments``, ``stores``, ``products``). Money stays in exact
decimals: item amounts are summed unrounded and rounded to cents once. Column
definitions are Spark SQL expressions, for ``mart_orders`` over its aliased inputs (``o``,
``i``, ``a``, ``s``), for ``mart_products`` over its joined columns.

Join plan: every fact-to-fact join is on ``order_id`` and each right side is
pre-aggregated or top-1'd to one row per order, so joins never fan out and the
order-keyed sides share one hash partitioning (no re-shuffle between them). The
dimension joins (stores, products) come last; Spark broadcasts them only when its
size estimate or adaptive runtime statistics show they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.functions.columns import calendar_columns, city_sql, flag_sql, service_cancel_sql
from lastmile.functions.conform import conform
from lastmile.functions.measures import item_measures
from lastmile.operators.dedupe import first_per_group
from lastmile.operators.skew import default_share, hot_keys, parted
from lastmile.schemas import MART_ORDERS, MART_PRODUCTS


def orders_calendar(orders: DataFrame) -> DataFrame:
    """Orders plus ``order_date`` and its year, month and day."""
    return orders.withColumns(calendar_columns("created_at"))


def items_enriched(order_items: DataFrame) -> DataFrame:
    """Order items with the six money measures (unrounded)."""
    return item_measures(order_items)


def items_agg(items: DataFrame) -> DataFrame:
    """Per order: item counts and amounts (rounded to cents after an exact sum)."""
    return items.groupBy("order_id").agg(
        F.expr("CAST(sum(item_quantity) AS INT)").alias("total_items_count"),
        F.expr("CAST(sum(item_canceled_quantity) AS INT)").alias("canceled_items_count"),
        F.expr("CAST(sum(item_paid_quantity) AS INT)").alias("paid_items_count"),
        F.expr("round(sum(gross_amount), 2)").alias("items_gross_amount"),
        F.expr("round(sum(discount_amount), 2)").alias("items_discount_amount"),
        F.expr("round(sum(turnover_amount), 2)").alias("items_turnover_amount"),
        F.expr("round(sum(canceled_amount), 2)").alias("items_canceled_amount"),
        F.expr("round(sum(revenue_amount), 2)").alias("paid_items_amount"),
    )


def assignment_agg(assignments: DataFrame) -> DataFrame:
    """Per order: first delivery start, last delivery and distinct drivers."""
    return assignments.groupBy("order_id").agg(
        F.expr("min(delivery_started_at)").alias("first_delivery_started_at"),
        F.expr("max(delivered_at)").alias("delivered_at"),
        F.expr("CAST(count(DISTINCT driver_id) AS INT)").alias("assigned_driver_count"),
    )


def first_driver(assignments: DataFrame) -> DataFrame:
    """Per order, the assignment that started first (then delivered first, then the
    lowest driver id); nulls last."""
    picked = first_per_group(
        assignments,
        ["order_id"],
        ["delivery_started_at ASC NULLS LAST", "delivered_at ASC NULLS LAST", "driver_id ASC NULLS LAST"],
    )
    return picked.select("order_id", "driver_id", "delivered_at")


_DISC = "coalesce(CAST(o.order_discount AS DECIMAL(10,0)), 0BD)"
_COST = "coalesce(o.delivery_cost, 0BD)"
_DRIVERS = "coalesce(a.assigned_driver_count, 0)"

MART_ORDERS_SQL = {
    "order_id": "o.order_id",
    "user_id": "o.user_id",
    "store_id": "o.store_id",
    "order_date": "o.order_date",
    "order_year": "o.order_year",
    "order_month": "o.order_month",
    "order_day": "o.order_day",
    "city": city_sql("s.store_address"),
    "store_address": "s.store_address",
    "delivery_address": "o.address_text",
    "payment_type": "o.payment_type",
    "order_cancellation_reason": "o.order_cancellation_reason",
    "created_at": "o.created_at",
    "paid_at": "o.paid_at",
    "canceled_at": "o.canceled_at",
    "first_delivery_started_at": "a.first_delivery_started_at",
    "delivered_at": "a.delivered_at",
    "order_discount": f"round({_DISC}, 2)",
    "delivery_cost": f"round({_COST}, 2)",
    "total_items_count": "coalesce(i.total_items_count, 0)",
    "canceled_items_count": "coalesce(i.canceled_items_count, 0)",
    "paid_items_count": "coalesce(i.paid_items_count, 0)",
    "items_gross_amount": "round(coalesce(i.items_gross_amount, 0BD), 2)",
    "items_discount_amount": "round(coalesce(i.items_discount_amount, 0BD), 2)",
    "items_turnover_amount": "round(coalesce(i.items_turnover_amount, 0BD), 2)",
    "items_canceled_amount": "round(coalesce(i.items_canceled_amount, 0BD), 2)",
    "paid_items_amount": "round(coalesce(i.paid_items_amount, 0BD), 2)",
    "turnover_amount": f"round(coalesce(i.items_turnover_amount, 0BD) - {_DISC}, 2)",
    "revenue_amount": f"round(coalesce(i.paid_items_amount, 0BD) - {_DISC} + {_COST}, 2)",
    # The source defines profit with the same expression as revenue.
    "profit_amount": f"round(coalesce(i.paid_items_amount, 0BD) - {_DISC} + {_COST}, 2)",
    "created_order_flag": "1",
    "delivered_order_flag": flag_sql("a.delivered_at IS NOT NULL"),
    "canceled_order_flag": flag_sql("o.canceled_at IS NOT NULL"),
    "canceled_after_delivery_flag": flag_sql("o.canceled_at IS NOT NULL AND a.delivered_at IS NOT NULL"),
    "service_cancel_flag": service_cancel_sql("o.order_cancellation_reason"),
    "assigned_driver_count": _DRIVERS,
    "courier_changed_flag": flag_sql(f"{_DRIVERS} > 1"),
    "active_driver_flag": flag_sql(f"{_DRIVERS} > 0"),
}

MART_PRODUCTS_SQL = {
    "order_item_id": "order_item_id",
    "order_id": "order_id",
    "user_id": "user_id",
    "store_id": "store_id",
    "driver_id": "driver_id",
    "product_id": "item_id",
    "replaced_product_id": "item_replaced_id",
    "product_title": "item_title",
    "product_category": "item_category",
    "order_date": "order_date",
    "order_year": "order_year",
    "order_month": "order_month",
    "order_day": "order_day",
    "city": city_sql("store_address"),
    "store_address": "store_address",
    "payment_type": "payment_type",
    "order_cancellation_reason": "order_cancellation_reason",
    "created_at": "created_at",
    "paid_at": "paid_at",
    "canceled_at": "canceled_at",
    "delivered_at": "delivered_at",
    "item_quantity": "item_quantity",
    "item_canceled_quantity": "item_canceled_quantity",
    "item_paid_quantity": "item_paid_quantity",
    "item_price": "round(item_price, 2)",
    "item_discount": "round(item_discount, 2)",
    "gross_amount": "round(gross_amount, 2)",
    "discount_amount": "round(discount_amount, 2)",
    "turnover_amount": "round(turnover_amount, 2)",
    "canceled_amount": "round(canceled_amount, 2)",
    "revenue_amount": "round(revenue_amount, 2)",
    "created_order_flag": "1",
    "delivered_order_flag": flag_sql("delivered_at IS NOT NULL"),
    "canceled_order_flag": flag_sql("canceled_at IS NOT NULL"),
    "service_cancel_flag": service_cancel_sql("order_cancellation_reason"),
    "item_has_cancellation_flag": flag_sql("item_canceled_quantity > 0"),
}

#: What an item shows of its order.
_OF_ORDER = ("user_id", "store_id", "payment_type", "order_cancellation_reason", "created_at", "paid_at", "canceled_at")


def _project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in exprs.items()])


def _apart(df: DataFrame, hot: list) -> tuple[DataFrame, DataFrame]:
    """Rows of the hot orders, and the others. The hottest few are also named in a filter
    that is pushed down, so whole row groups of theirs are skipped by the others' scan."""
    busy, ordinary = parted(df, ["order_id"], hot)
    named = ", ".join(str(int(k)) for (k,) in hot[:10])
    return busy, ordinary.filter(f"order_id IS NULL OR order_id NOT IN ({named})")


def mart_orders(
    orders: DataFrame,
    order_items: DataFrame,
    assignments: DataFrame,
    stores: DataFrame,
    hot: list | None = None,
) -> DataFrame:
    """One row per order with calendar, place, item totals, money and status flags.

    Rows are combined by order before they are shuffled. Tables bucketed by order aren't
    shuffled at all, so there the orders of very many rows, if the caller names them
    (``hot``), are built apart, from scans that spread over tasks.
    """

    def built(orders: DataFrame, items: DataFrame, its_assignments: DataFrame) -> DataFrame:
        o = orders_calendar(orders).alias("o")
        i = items_agg(items_enriched(items)).alias("i")
        a = assignment_agg(its_assignments).alias("a")
        joined = (
            o.join(i, F.expr("o.order_id = i.order_id"), "left")
            .join(a, F.expr("o.order_id = a.order_id"), "left")
            .join(stores.alias("s"), F.expr("o.store_id = s.store_id"), "left")
        )
        return conform(_project(joined, MART_ORDERS_SQL), MART_ORDERS)

    if not hot:
        return built(orders, order_items, assignments)
    sides = [_apart(df, hot) for df in (orders, order_items, assignments)]
    return built(*(ordinary for _, ordinary in sides)).unionByName(built(*(busy for busy, _ in sides)))


def mart_products(
    orders: DataFrame,
    order_items: DataFrame,
    assignments: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    hot: list | None = None,
) -> DataFrame:
    """One row per order item with its order's context, first driver and amounts.

    ``delivered_at`` here is the first driver's, unlike ``mart_orders`` which takes
    the latest delivery over all assignments.

    Items of orders that hold very many of them (``hot``; found in a sample of the order ids
    if the caller doesn't know them) don't take part in the joins by order id: their few orders and first drivers, one row each,
    are broadcast to them wherever they are.
    """

    def with_order(items: DataFrame, its_orders: DataFrame, its_drivers: DataFrame) -> DataFrame:
        joined = items.alias("oi").join(its_orders.alias("o"), F.expr("oi.order_id = o.order_id"), "left")
        return joined.join(its_drivers.alias("fd"), F.expr("oi.order_id = fd.order_id"), "left")

    def finished(joined: DataFrame, address: str) -> DataFrame:
        # measures and calendar come after the last join, whose shuffle they would only widen
        found = joined.join(products.alias("p"), F.expr("oi.item_id = p.item_id"), "left")
        rows = found.select("oi.*", *[f"o.{c}" for c in _OF_ORDER], "fd.driver_id", "fd.delivered_at", address, "p.item_title", "p.item_category")
        return conform(_project(orders_calendar(items_enriched(rows)), MART_PRODUCTS_SQL), MART_PRODUCTS)

    def whole(items: DataFrame) -> DataFrame:
        joined = with_order(items, orders, first_driver(assignments))
        return finished(joined.join(stores.alias("s"), F.expr("o.store_id = s.store_id"), "left"), "s.store_address")

    if hot is None:
        hot = hot_keys(order_items.filter("order_id IS NOT NULL"), ["order_id"], default_share(order_items))
    if not hot:
        return whole(order_items)
    busy, ordinary = _apart(order_items, hot)
    # the store is joined to the few orders, not to their many items
    its_orders = parted(orders, ["order_id"], hot)[0].join(stores, "store_id", "left")
    its_drivers = first_driver(parted(assignments, ["order_id"], hot)[0])
    joined = with_order(busy, F.broadcast(its_orders), F.broadcast(its_drivers))
    return whole(ordinary).unionByName(finished(joined, "o.store_address"))


def build_mart(name: str, tables: dict[str, DataFrame], hot: list | None = None) -> DataFrame:
    """Build a mart by name from a dict of warehouse tables; ``hot`` lists
    the orders of very many rows, if the caller knows them."""
    if name == "mart_orders":
        return mart_orders(tables["orders"], tables["order_items"], tables["order_driver_assignments"], tables["stores"], hot)
    if name == "mart_products":
        return mart_products(
            tables["orders"],
            tables["order_items"],
            tables["order_driver_assignments"],
            tables["stores"],
            tables["products"],
            hot,
        )
    raise ValueError(f"Unknown mart type: {name!r}")
