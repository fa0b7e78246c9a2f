"""Normalise raw order rows into the seven warehouse tables.

One builder per table, each a pure ``raw -> table`` function. The full load applies
them to the whole lake, the incremental load to one time slice; both use the same
code (nulls sort last everywhere).

Determinism: wherever the source picks "some" row, the choice here is fixed by a
total order - the stated ordering first, then every kept column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from lastmile.functions.columns import assignment_id, order_item_id
from lastmile.functions.conform import conform
from lastmile.operators.dedupe import dedupe_by_key, first_per_group, first_per_spread_group
from lastmile.operators.sequence import number_within_groups
from lastmile.operators.skew import default_share, hot_keys
from lastmile.schemas import (
    DRIVERS,
    ORDER_DRIVER_ASSIGNMENTS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    STORES,
    USERS,
    TableSpec,
    warehouse_table,
)


def _asc(cols) -> list[str]:
    return [f"{c} ASC NULLS LAST" for c in cols]


def _dimension(spec: TableSpec) -> Callable[[DataFrame], DataFrame]:
    attrs = [c for c in spec.columns if c != spec.pk]

    def build(raw: DataFrame) -> DataFrame:
        return conform(dedupe_by_key(raw, spec.pk, attrs), spec.schema)

    build.__name__ = spec.name
    build.__doc__ = f"``{spec.name}``: one row per non-null ``{spec.pk}``, smallest attributes first."
    return build


users = _dimension(USERS)
drivers = _dimension(DRIVERS)
stores = _dimension(STORES)
products = _dimension(PRODUCTS)


def orders(raw: DataFrame) -> DataFrame:
    """Latest version of each order: greatest ``created_at`` (nulls last)."""
    cols = ORDERS.columns
    rest = [c for c in cols if c not in ("order_id", "created_at")]
    picked = first_per_group(
        raw.filter("order_id IS NOT NULL").select(*cols),
        ["order_id"],
        ["created_at DESC NULLS LAST", *_asc(rest)],
    )
    return conform(picked, ORDERS.schema)


def hot_orders(raw: DataFrame) -> list:
    """Orders that hold a large share of the raw rows: found once, used by both facts."""
    return hot_keys(raw.filter("order_id IS NOT NULL"), ["order_id"], default_share(raw))


def order_items(raw: DataFrame, hot: list | None = None) -> DataFrame:
    """Every item row, keyed ``<order>_<item>_<n>``; n counts repeats of the item in the
    order by ``created_at`` (nulls last). ``hot`` lists the orders of very many rows, if the
    caller knows them."""
    value_cols = [c for c in ORDER_ITEMS.columns if c not in ("order_item_id", "order_id", "item_id")]
    rows = raw.filter("order_id IS NOT NULL AND item_id IS NOT NULL").select(
        "order_id", "item_id", "created_at", *value_cols
    )
    numbered = number_within_groups(
        rows,
        ["order_id", "item_id"],
        ["created_at ASC NULLS LAST", *_asc(value_cols)],
        name="row_num",
        hot_first=hot,
    )
    return conform(numbered.withColumn("order_item_id", order_item_id()), ORDER_ITEMS.schema)


def order_driver_assignments(raw: DataFrame, hot: list | None = None) -> DataFrame:
    """One row per (order, driver, delivery start); the latest raw row wins. ``hot`` as in
    ``order_items``."""
    rows = raw.filter("order_id IS NOT NULL AND driver_id IS NOT NULL").select(
        "order_id", "driver_id", "delivery_started_at", "delivered_at", "created_at"
    )
    picked = first_per_spread_group(
        rows,
        ["order_id", "driver_id", "delivery_started_at"],
        ["created_at DESC NULLS LAST", "delivered_at ASC NULLS LAST"],
        hot,
    )
    return conform(picked.withColumn("assignment_id", assignment_id()), ORDER_DRIVER_ASSIGNMENTS.schema)


BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "users": users,
    "drivers": drivers,
    "stores": stores,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "order_driver_assignments": order_driver_assignments,
}


#: Tables whose groups lie within an order, which may hold very many rows.
BY_ORDER = ("order_items", "order_driver_assignments")


def build_table(raw: DataFrame, name: str, hot: list | None = None) -> DataFrame:
    """Build one warehouse table by name; unknown names raise ``ValueError``. ``hot`` as in
    ``order_items``."""
    warehouse_table(name)
    return BUILDERS[name](raw, hot) if name in BY_ORDER else BUILDERS[name](raw)


def build_tables(raw: DataFrame, names: Sequence[str], hot: list | None = None) -> dict[str, DataFrame]:
    """Several tables; the hot orders are looked for once, and only if a table needs them."""
    if hot is None and any(n in BY_ORDER for n in names):
        hot = hot_orders(raw)
    return {n: build_table(raw, n, hot) for n in names}


def build_all(raw: DataFrame, hot: list | None = None) -> dict[str, DataFrame]:
    """All seven tables, in foreign-key load order."""
    return build_tables(raw, tuple(BUILDERS), hot)
