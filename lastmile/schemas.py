"""Table definitions: raw lake rows, the seven warehouse tables and the two marts.

Each warehouse table carries its key metadata (primary key, columns an upsert may
overwrite, NOT NULL columns, foreign keys) so that loads, upserts and checks are
all driven from one place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
TS = T.TimestampNTZType()
DATE = T.DateType()
PRICE = T.DecimalType(12, 2)
# item_discount is a fraction (0.05 = 5 %); the measures multiply by (1 - discount).
DISCOUNT = T.DecimalType(5, 4)
MONEY = T.DecimalType(14, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Names, types, keys, updatable columns and references of the raw rows, the
# warehouse tables and the marts below are the contract that all loads and checks share.
RAW = _struct(
    ("order_id", LONG),
    ("user_id", LONG),
    ("user_phone", STR),
    ("driver_id", LONG),
    ("driver_phone", STR),
    ("store_id", LONG),
    ("store_address", STR),
    ("item_id", LONG),
    ("item_title", STR),
    ("item_category", STR),
    ("item_quantity", INT),
    ("item_price", PRICE),
    ("item_canceled_quantity", INT),
    ("item_discount", DISCOUNT),
    ("item_replaced_id", LONG),
    ("address_text", STR),
    ("created_at", TS),
    ("paid_at", TS),
    ("canceled_at", TS),
    ("payment_type", STR),
    ("order_discount", INT),
    ("order_cancellation_reason", STR),
    ("delivery_cost", PRICE),
    ("delivery_started_at", TS),
    ("delivered_at", TS),
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    pk: str
    updatable: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


USERS = TableSpec(
    "users",
    _struct(("user_id", LONG), ("user_phone", STR)),
    pk="user_id",
    updatable=("user_phone",),
)

DRIVERS = TableSpec(
    "drivers",
    _struct(("driver_id", LONG), ("driver_phone", STR)),
    pk="driver_id",
    updatable=("driver_phone",),
)

STORES = TableSpec(
    "stores",
    _struct(("store_id", LONG), ("store_address", STR)),
    pk="store_id",
    updatable=("store_address",),
    not_null=("store_address",),
)

PRODUCTS = TableSpec(
    "products",
    _struct(("item_id", LONG), ("item_title", STR), ("item_category", STR)),
    pk="item_id",
    updatable=("item_title", "item_category"),
    not_null=("item_title",),
)

ORDERS = TableSpec(
    "orders",
    _struct(
        ("order_id", LONG),
        ("user_id", LONG),
        ("store_id", LONG),
        ("address_text", STR),
        ("created_at", TS),
        ("paid_at", TS),
        ("canceled_at", TS),
        ("payment_type", STR),
        ("order_discount", INT),
        ("order_cancellation_reason", STR),
        ("delivery_cost", PRICE),
    ),
    pk="order_id",
    # created_at, user_id and store_id keep the first loaded value on upsert.
    updatable=(
        "address_text",
        "paid_at",
        "canceled_at",
        "payment_type",
        "order_discount",
        "order_cancellation_reason",
        "delivery_cost",
    ),
    not_null=("user_id", "store_id", "created_at"),
    foreign_keys=(
        ForeignKey("user_id", "users", "user_id"),
        ForeignKey("store_id", "stores", "store_id"),
    ),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    _struct(
        ("order_item_id", STR),
        ("order_id", LONG),
        ("item_id", LONG),
        ("item_quantity", INT),
        ("item_price", PRICE),
        ("item_canceled_quantity", INT),
        ("item_discount", DISCOUNT),
        ("item_replaced_id", LONG),
    ),
    pk="order_item_id",
    updatable=(
        "item_quantity",
        "item_price",
        "item_canceled_quantity",
        "item_discount",
        "item_replaced_id",
    ),
    not_null=("order_id", "item_id"),
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("item_id", "products", "item_id"),
        ForeignKey("item_replaced_id", "products", "item_id"),
    ),
)

ORDER_DRIVER_ASSIGNMENTS = TableSpec(
    "order_driver_assignments",
    _struct(
        ("assignment_id", STR),
        ("order_id", LONG),
        ("driver_id", LONG),
        ("delivery_started_at", TS),
        ("delivered_at", TS),
    ),
    pk="assignment_id",
    updatable=("delivery_started_at", "delivered_at"),
    not_null=("order_id", "driver_id"),
    foreign_keys=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("driver_id", "drivers", "driver_id"),
    ),
)

# Load order satisfies the foreign keys: dimensions, then orders, then the two facts.
WAREHOUSE: dict[str, TableSpec] = {
    t.name: t
    for t in (
        USERS,
        DRIVERS,
        STORES,
        PRODUCTS,
        ORDERS,
        ORDER_ITEMS,
        ORDER_DRIVER_ASSIGNMENTS,
    )
}


def warehouse_table(name: str) -> TableSpec:
    try:
        return WAREHOUSE[name]
    except KeyError:
        raise ValueError(f"Unknown warehouse table: {name!r}") from None


MART_ORDERS = _struct(
    ("order_id", LONG),
    ("user_id", LONG),
    ("store_id", LONG),
    ("order_date", DATE),
    ("order_year", INT),
    ("order_month", INT),
    ("order_day", INT),
    ("city", STR),
    ("store_address", STR),
    ("delivery_address", STR),
    ("payment_type", STR),
    ("order_cancellation_reason", STR),
    ("created_at", TS),
    ("paid_at", TS),
    ("canceled_at", TS),
    ("first_delivery_started_at", TS),
    ("delivered_at", TS),
    ("order_discount", MONEY),
    ("delivery_cost", MONEY),
    ("total_items_count", INT),
    ("canceled_items_count", INT),
    ("paid_items_count", INT),
    ("items_gross_amount", MONEY),
    ("items_discount_amount", MONEY),
    ("items_turnover_amount", MONEY),
    ("items_canceled_amount", MONEY),
    ("paid_items_amount", MONEY),
    ("turnover_amount", MONEY),
    ("revenue_amount", MONEY),
    ("profit_amount", MONEY),
    ("created_order_flag", INT),
    ("delivered_order_flag", INT),
    ("canceled_order_flag", INT),
    ("canceled_after_delivery_flag", INT),
    ("service_cancel_flag", INT),
    ("assigned_driver_count", INT),
    ("courier_changed_flag", INT),
    ("active_driver_flag", INT),
)

MART_PRODUCTS = _struct(
    ("order_item_id", STR),
    ("order_id", LONG),
    ("user_id", LONG),
    ("store_id", LONG),
    ("driver_id", LONG),
    ("product_id", LONG),
    ("replaced_product_id", LONG),
    ("product_title", STR),
    ("product_category", STR),
    ("order_date", DATE),
    ("order_year", INT),
    ("order_month", INT),
    ("order_day", INT),
    ("city", STR),
    ("store_address", STR),
    ("payment_type", STR),
    ("order_cancellation_reason", STR),
    ("created_at", TS),
    ("paid_at", TS),
    ("canceled_at", TS),
    ("delivered_at", TS),
    ("item_quantity", INT),
    ("item_canceled_quantity", INT),
    ("item_paid_quantity", INT),
    ("item_price", MONEY),
    ("item_discount", MONEY),
    ("gross_amount", MONEY),
    ("discount_amount", MONEY),
    ("turnover_amount", MONEY),
    ("canceled_amount", MONEY),
    ("revenue_amount", MONEY),
    ("created_order_flag", INT),
    ("delivered_order_flag", INT),
    ("canceled_order_flag", INT),
    ("service_cancel_flag", INT),
    ("item_has_cancellation_flag", INT),
)

MARTS: dict[str, T.StructType] = {
    "mart_orders": MART_ORDERS,
    "mart_products": MART_PRODUCTS,
}
