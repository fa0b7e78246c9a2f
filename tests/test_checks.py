"""Data-quality checks report violations of keys, references and NOT NULLs."""

import pytest

from lastmile.operators import checks
from lastmile.plans import warehouse
from lastmile.schemas import WAREHOUSE


def _as_dict(df):
    return {(r.table_name, r.constraint_name): r.violations for r in df.collect()}


def test_clean_tables_pass(make_raw):
    t = warehouse.build_all(
        make_raw([{"order_id": 1, "user_id": 1, "store_id": 1, "store_address": "a", "item_id": 2,
                   "item_title": "x", "driver_id": 3, "created_at": "2000-01-01 00:00:00"}])
    )
    for result in (
        checks.check_nonempty(t),
        checks.check_primary_keys(t, WAREHOUSE),
        checks.check_foreign_keys(t, WAREHOUSE),
        checks.check_not_null(t, WAREHOUSE),
    ):
        checks.assert_checks_pass(result)


def test_violations_are_counted(make_raw, spark):
    t = warehouse.build_all(
        make_raw([{"order_id": 1, "user_id": 1, "store_id": 1, "store_address": None, "item_id": 2,
                   "item_replaced_id": 99, "created_at": None, "item_discount": "1.5"}])
    )
    t["users"] = t["users"].unionByName(t["users"])  # duplicate key
    t["drivers"] = t["drivers"].limit(0)
    pk = _as_dict(checks.check_primary_keys(t, WAREHOUSE))
    assert pk[("users", "pk_user_id")] == 1
    fk = _as_dict(checks.check_foreign_keys(t, WAREHOUSE))
    assert fk[("order_items", "fk_item_replaced_id_products")] == 1
    assert fk[("orders", "fk_user_id_users")] == 0
    nn = _as_dict(checks.check_not_null(t, WAREHOUSE))
    assert nn[("stores", "not_null_store_address")] == 1
    assert nn[("orders", "not_null_created_at")] == 1
    ne = _as_dict(checks.check_nonempty(t))
    assert ne[("drivers", "non_empty")] == 1 and ne[("orders", "non_empty")] == 0
    assert _as_dict(checks.check_discount_range(t["order_items"]))[("order_items", "range_item_discount_0_1")] == 1
    with pytest.raises(ValueError, match="drivers.non_empty"):
        checks.assert_checks_pass(checks.check_nonempty(t))
