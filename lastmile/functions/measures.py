"""Item-level money measures, computed in exact decimal arithmetic.

With q, c = ordered and canceled quantity, p = unit price and d = discount
fraction (missing values count as zero):

    item_paid_quantity = q - c
    gross_amount       = q * p
    discount_amount    = q * p * d
    turnover_amount    = q * p * (1 - d)
    canceled_amount    = c * p * (1 - d)
    revenue_amount     = (q - c) * p * (1 - d)

Amounts stay unrounded decimals here; they are summed exactly and rounded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Inputs coalesced to zero (0BD is a decimal literal, so money never becomes double).
_INPUTS = {
    "item_quantity": "coalesce(item_quantity, 0)",
    "item_canceled_quantity": "coalesce(item_canceled_quantity, 0)",
    "item_price": "coalesce(item_price, 0BD)",
    "item_discount": "coalesce(item_discount, 0BD)",
}
MEASURES = {
    "item_paid_quantity": "item_quantity - item_canceled_quantity",
    "gross_amount": "item_quantity * item_price",
    "discount_amount": "item_quantity * item_price * item_discount",
    "turnover_amount": "item_quantity * item_price * (1BD - item_discount)",
    "canceled_amount": "item_canceled_quantity * item_price * (1BD - item_discount)",
    "revenue_amount": "(item_quantity - item_canceled_quantity) * item_price * (1BD - item_discount)",
}


def item_measures(items: DataFrame) -> DataFrame:
    """Add the six item measures to an ``order_items`` frame (inputs coalesced to 0)."""
    inputs = [f"{_INPUTS[c]} AS {c}" if c in _INPUTS else f"`{c}`" for c in items.columns]
    return items.selectExpr(*inputs).selectExpr("*", *[f"{sql} AS {name}" for name, sql in MEASURES.items()])
