"""Scalar column expressions shared by the warehouse loads and the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cancellation reasons that count as the service's fault.
SERVICE_CANCEL_REASONS = ("Ошибка приложения", "Проблемы с оплатой")

# Fixed value: assignment key part used when delivery has not started.
NO_START = "no_start"


def order_item_id(order_id: str = "order_id", item_id: str = "item_id", seq: str = "row_num") -> Column:
    """``<order_id>_<item_id>_<n>``: n numbers repeats of one item inside one order."""
    return F.expr(f"concat_ws('_', {order_id}, {item_id}, {seq})")


def assignment_id(
    order_id: str = "order_id",
    driver_id: str = "driver_id",
    started_at: str = "delivery_started_at",
) -> Column:
    """``<order_id>_<driver_id>_<start timestamp text or "no_start">``."""
    return F.expr(f"concat_ws('_', {order_id}, {driver_id}, coalesce(CAST({started_at} AS STRING), '{NO_START}'))")


def calendar_sql(ts: str = "created_at") -> dict[str, str]:
    """Date and its parts of a (zone-less) timestamp, as SQL expressions."""
    return {
        "order_date": f"to_date({ts})",
        "order_year": f"year({ts})",
        "order_month": f"month({ts})",
        "order_day": f"dayofmonth({ts})",
    }


def calendar_columns(ts: str = "created_at") -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in calendar_sql(ts).items()}


def city_sql(address: str) -> str:
    """City = the trimmed text before the first comma of a store address."""
    return f"trim(split({address}, ',')[0])"


def flag_sql(condition: str) -> str:
    """1 when the condition holds, 0 when it is false or unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def service_cancel_sql(reason: str) -> str:
    reasons = ", ".join(f"'{r}'" for r in SERVICE_CANCEL_REASONS)
    return flag_sql(f"{reason} IN ({reasons})")
