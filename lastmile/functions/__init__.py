"""Column expressions: calendar parts, city, surrogate keys, money measures, flags."""

from lastmile.functions.columns import (
    SERVICE_CANCEL_REASONS,
    assignment_id,
    calendar_columns,
    calendar_sql,
    city_sql,
    flag_sql,
    order_item_id,
    service_cancel_sql,
)
from lastmile.functions.conform import conform, decimals_as_double
from lastmile.functions.measures import item_measures

__all__ = [
    "SERVICE_CANCEL_REASONS",
    "assignment_id",
    "calendar_columns",
    "calendar_sql",
    "city_sql",
    "conform",
    "decimals_as_double",
    "flag_sql",
    "service_cancel_sql",
    "item_measures",
    "order_item_id",
]
