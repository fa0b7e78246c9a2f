"""Relational building blocks: top-1 per group, deduplication, skew-safe numbering,
keyed upsert and data-quality checks."""

from lastmile.operators.checks import (
    assert_checks_pass,
    check_discount_range,
    check_foreign_keys,
    check_nonempty,
    check_not_null,
    check_primary_keys,
)
from lastmile.operators.dedupe import dedupe_by_key, first_per_group
from lastmile.operators.sequence import number_within_groups
from lastmile.operators.upsert import upsert

__all__ = [
    "assert_checks_pass",
    "check_discount_range",
    "check_foreign_keys",
    "check_nonempty",
    "check_not_null",
    "check_primary_keys",
    "dedupe_by_key",
    "first_per_group",
    "number_within_groups",
    "upsert",
]
