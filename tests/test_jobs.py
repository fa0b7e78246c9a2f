"""End-to-end jobs on written tables: full load, incremental load (batch and
streaming) and the mart build agree with the registered queries."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lastmile.functions.conform import decimals_as_double
from lastmile.plans import jobs
from lastmile.plans.queries import QUERIES, SLICE_END, SLICE_START
from lastmile.schemas import WAREHOUSE
from lastmile.sources.lake import ts_literal
from lastmile.sources.testdata import raw_from_tables, with_resent_rows
from lastmile.streaming.incremental import start_incremental_stream, upsert_batch, version_root


def _same(a, b):
    a, b = decimals_as_double(a), decimals_as_double(b.select(*a.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_full_incremental_and_marts(spark, tmp_path):
    raw = with_resent_rows(raw_from_tables(spark, SF_SMALL))
    base_raw = raw.filter(F.col("created_at") < ts_literal(SLICE_START))
    w0, w1, m = (str(tmp_path / d) for d in ("w0", "w1", "marts"))
    jobs.full_load(spark, base_raw, w0)
    jobs.incremental_load(spark, raw, SLICE_START, SLICE_END, w0, w1)
    merged = jobs.read_warehouse(spark, w1)
    for name in WAREHOUSE:
        assert _same(merged[name], QUERIES[f"merged_{name}"](spark, SF_SMALL)), name
    jobs.build_marts(spark, w1, m)
    result = jobs.validate_warehouse(spark, w1)
    assert result.filter("constraint_name LIKE 'pk_%' AND violations > 0").isEmpty()


def test_full_load_matches_queries(spark, tmp_path):
    raw = raw_from_tables(spark, SF_SMALL)
    w, m = str(tmp_path / "w"), str(tmp_path / "m")
    jobs.full_load(spark, raw, w)
    jobs.build_marts(spark, w, m)
    got = spark.read.parquet(f"{m}/mart_orders")
    assert _same(got, QUERIES["mart_orders"](spark, SF_SMALL))


def test_streaming_upsert_matches_batch(spark, tmp_path):
    raw = with_resent_rows(raw_from_tables(spark, SF_SMALL))
    w0, lake, versions = (str(tmp_path / d) for d in ("w0", "lake", "versions"))
    jobs.full_load(spark, raw.filter(F.col("created_at") < ts_literal(SLICE_START)), w0)
    delta_raw = raw.filter((F.col("created_at") >= ts_literal(SLICE_START)) & (F.col("created_at") < ts_literal(SLICE_END)))
    delta_raw.coalesce(1).write.parquet(lake)
    q = start_incremental_stream(spark, lake, w0, versions, checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    out = jobs.read_warehouse(spark, version_root(versions, 0))
    for name in ("orders", "order_items", "users"):
        assert _same(out[name], QUERIES[f"merged_{name}"](spark, SF_SMALL)), name


def test_constraints_are_enforced_by_the_jobs(spark, make_raw, tmp_path):
    good = {"order_id": 1, "user_id": 1, "store_id": 1, "store_address": "a", "item_id": 1, "item_title": "x", "driver_id": 2, "created_at": "2000-01-05 00:00:00"}
    cases = {
        "orders.not_null_created_at": {"created_at": None},
        "orders.not_null_user_id": {"user_id": None},
        "stores.not_null_store_address": {"store_address": None},
        "products.not_null_item_title": {"item_title": None},
        "order_items.fk_item_replaced_id_products": {"item_replaced_id": 9},
        "order_items.range_item_discount_0_1": {"item_discount": "1.5"},
        "drivers.non_empty": {"driver_id": None},
    }
    for k, (constraint, change) in enumerate(cases.items()):
        rows = [good | change, good | {"order_id": 2}] if constraint != "drivers.non_empty" else [good | change]
        if "address" in constraint or "title" in constraint:
            rows = [good | change]
        root = str(tmp_path / f"w{k}")
        with pytest.raises(ValueError, match=constraint.replace(".", "[.]")):
            jobs.full_load(spark, make_raw(rows), root)
        report = jobs.validate_warehouse(spark, root, strict=False).filter("violations > 0").collect()
        assert constraint in [f"{r.table_name}.{r.constraint_name}" for r in report]
    jobs.full_load(spark, make_raw([good]), str(tmp_path / "good"))
    bad = make_raw([good | {"order_id": 3, "item_replaced_id": 77, "created_at": "2000-01-06 00:00:00"}])
    with pytest.raises(ValueError, match="fk_item_replaced_id_products=1"):
        jobs.incremental_load(spark, bad, "2000-01-06", "2000-01-07", str(tmp_path / "good"), str(tmp_path / "next"))
    jobs.incremental_load(spark, bad, "2000-01-06", "2000-01-07", str(tmp_path / "good"), str(tmp_path / "reported"), strict=False)


def test_database_jobs_name_their_tables_ranges_and_order(spark, tmp_path, monkeypatch):
    raw, written, read = raw_from_tables(spark, SF_SMALL), [], {}
    monkeypatch.setattr(jobs.jdbc, "write_jdbc", lambda df, url, table, connection, **kw: written.append((table, kw["mode"], df.count())))
    jobs.full_load_jdbc(spark, raw, str(tmp_path / "stage"), "jdbc:x", {"user": "u"})
    assert [t for t, _, _ in written] == [f"dwh.{n}" for n in WAREHOUSE] and {m for _, m, _ in written} == {"overwrite"}
    stage = jobs.read_warehouse(spark, str(tmp_path / "stage"))
    monkeypatch.setattr(jobs.jdbc, "key_bounds", lambda *a: (1, 99))
    monkeypatch.setattr(jobs.jdbc, "read_jdbc", lambda s, url, table, connection, **kw: read.setdefault(table, kw) and stage[table[4:]] or stage[table[4:]])
    written.clear()
    jobs.build_marts_jdbc(spark, str(tmp_path / "marts"), "jdbc:x", {})
    assert {t: n for t, _, n in written} == {"mart.mart_orders": stage["orders"].count(), "mart.mart_products": stage["order_items"].count()}
    assert read["dwh.orders"] == {"partition_column": "order_id", "lower_bound": 1, "upper_bound": 100, "num_partitions": 8} and read["dwh.stores"] == {}


def test_streaming_versions_chain(spark, make_raw, tmp_path):
    good = {"order_id": 1, "user_id": 1, "store_id": 1, "store_address": "a", "item_id": 1, "item_title": "x", "driver_id": 2, "created_at": "2000-01-05 00:00:00"}
    w0, versions = str(tmp_path / "w0"), str(tmp_path / "versions")
    jobs.full_load(spark, make_raw([good]), w0)
    upsert_batch(make_raw([good | {"order_id": 2}]), 0, w0, versions)
    upsert_batch(make_raw([good]).limit(0), 1, w0, versions)  # an empty batch writes no version
    upsert_batch(make_raw([good | {"order_id": 3}]), 2, w0, versions)
    assert sorted(r.order_id for r in jobs.read_warehouse(spark, version_root(versions, 2))["orders"].collect()) == [1, 2, 3]
