"""Bucketed catalog tables, marts built from them without a shuffle by order, and marts
that follow incremental loads."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lastmile.functions.conform import decimals_as_double
from lastmile.operators import skew
from lastmile.plans import marts, partitioned, stored_marts
from lastmile.plans.queries import QUERIES, SLICE_END, SLICE_START
from lastmile.schemas import MARTS, WAREHOUSE
from lastmile.sources import catalog, manifest
from lastmile.sources.lake import ts_literal
from lastmile.sources.testdata import raw_from_tables, with_resent_rows


def same(a, b):
    a, b = decimals_as_double(a), decimals_as_double(b.select(*a.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rebuilt(spark, root, name):
    return marts.build_mart(name, partitioned.read_tables(spark, root))


def row(order_id, **more):
    return {"order_id": order_id, "user_id": 1, "store_id": 1, "store_address": "A, b", "item_id": 1, "item_title": "x", "item_category": "c",
            "item_quantity": 2, "item_price": "3.50", "driver_id": 2, "created_at": "2000-01-05 00:00:00"} | more


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    with_resent_rows(raw_from_tables(spark, SF_SMALL)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def bucketed(spark, raw, tmp_path_factory):
    """A bucketed warehouse of a few months and its catalog."""
    root = str(tmp_path_factory.mktemp("wh"))
    some = raw.filter((F.col("created_at") >= ts_literal("1999-06-01")) & (F.col("created_at") < ts_literal("1999-10-01")))
    partitioned.full_load(spark, some, root, strict=False, buckets=4)
    catalog.bootstrap(spark, "wh_bucketed", root, buckets=4, mart_root=f"{root}/marts")
    yield root, some
    spark.sql("DROP DATABASE wh_bucketed CASCADE")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^#]*)#", plan)


def test_marts_of_bucketed_tables_hold_no_exchange_by_order(spark, bucketed):
    root, _ = bucketed
    tables = partitioned.read_tables(spark, root, "wh_bucketed")
    plain = partitioned.read_tables(spark, root)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in MARTS:
            assert "order_id" in exchanges(marts.build_mart(name, plain, []))
            assert "order_id" not in exchanges(marts.build_mart(name, tables, [])), name
            assert same(marts.build_mart(name, tables, []), marts.build_mart(name, plain, [])), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_orders_of_bucketed_tables_are_built_apart(spark, bucketed):
    root, _ = bucketed
    tables = partitioned.read_tables(spark, root, "wh_bucketed")
    hot = [(r.order_id,) for r in tables["order_items"].select("order_id").distinct().orderBy("order_id").limit(20).collect()]
    for name in MARTS:
        assert same(marts.build_mart(name, tables, hot), marts.build_mart(name, tables, [])), name


def test_stored_hot_orders(spark, make_raw, tmp_path, monkeypatch):
    rows = [row(1, item_id=i) for i in range(400)] + [row(i) for i in range(2, 60)]
    real = skew.hot_keys
    monkeypatch.setattr(partitioned, "hot_keys", lambda df, keys, share: real(df, keys, 0.1, 1.0, 20))
    root, mart_root = str(tmp_path / "w"), str(tmp_path / "m")
    partitioned.full_load(spark, make_raw(rows), root)
    assert manifest.current(spark, root).info["hot_orders"] == [1]
    stored_marts.build(spark, root, mart_root)
    for name in MARTS:
        assert same(stored_marts.read(spark, mart_root, name), rebuilt(spark, root, name))


def test_bootstrap_and_point_resolve_all_nine_tables_by_name(spark, bucketed):
    root, some = bucketed
    stored_marts.build(spark, root, f"{root}/marts", database="wh_bucketed")
    assert catalog.point(spark, "wh_bucketed", manifest.current(spark, f"{root}/marts").paths) >= 8
    for name in MARTS:
        assert same(spark.table(f"wh_bucketed.{name}").drop(catalog.MART_MONTH), rebuilt(spark, root, name)), name
    for name, table in partitioned.read_tables(spark, root).items():
        assert same(spark.sql(f"SELECT * FROM wh_bucketed.{name}").select(*table.columns), table), name
    assert {r.tableName for r in spark.sql("SHOW TABLES IN wh_bucketed").collect()} == {*WAREHOUSE, *MARTS}
    # again: nothing changes
    before = {n: spark.sql(f"DESCRIBE EXTENDED wh_bucketed.{n}").collect() for n in ("orders", "mart_orders", "users")}
    catalog.bootstrap(spark, "wh_bucketed", root, buckets=4, mart_root=f"{root}/marts")
    assert catalog.point(spark, "wh_bucketed", manifest.current(spark, root).paths) == 0
    assert {n: spark.sql(f"DESCRIBE EXTENDED wh_bucketed.{n}").collect() for n in before} == before
    said = {r.col_name: r.comment for r in spark.sql("DESCRIBE wh_bucketed.orders").collect()}
    assert said["order_id"] == "primary key" and said["store_id"] == "references stores.store_id"
    assert "created_at` timestamp_ntz NOT NULL" in catalog.create_statement("d", "orders", "/x")


def test_the_catalog_follows_an_incremental_load(spark, bucketed):
    root, _ = bucketed
    version = manifest.current(spark, root).version
    again = row(10**9, user_id=5, created_at="1999-07-07 00:00:00")
    from conftest import raw_rows

    partitioned.incremental_load(spark, raw_rows(spark, [again]), "1999-07-07", "1999-07-08", root, strict=False)
    assert manifest.current(spark, root).version == version + 1
    tables = partitioned.read_tables(spark, root, "wh_bucketed")
    assert tables["orders"].filter(f"order_id = {10**9}").count() == 1
    assert "order_id" not in exchanges(marts.items_agg(marts.items_enriched(tables["order_items"])))
    for name, table in partitioned.read_tables(spark, root).items():
        assert same(tables[name], table), name


def test_maintained_marts_equal_rebuilt_ones(spark, raw, tmp_path):
    root, mart_root = str(tmp_path / "w"), str(tmp_path / "m")
    base = raw.filter((F.col("created_at") >= ts_literal("1999-09-01")) & (F.col("created_at") < ts_literal(SLICE_START)))
    partitioned.full_load(spark, base, root, strict=False)
    stored_marts.build(spark, root, mart_root)
    for start, end in ((SLICE_START, "2000-01-20"), ("2000-01-20", SLICE_END)):
        partitioned.incremental_load(spark, raw, start, end, root, strict=False)
        stored_marts.maintain(spark, root, mart_root)
        for name in MARTS:
            assert same(stored_marts.read(spark, mart_root, name), rebuilt(spark, root, name)), (name, start)
    assert stored_marts.maintain(spark, root, mart_root) == {n: [] for n in MARTS}


@pytest.fixture
def small(spark, make_raw, tmp_path):
    """Five months of orders of two stores and products, with both marts."""
    root, mart_root = str(tmp_path / "w"), str(tmp_path / "m")
    rows = [row(i, store_id=1 + (m == 3), store_address="A, b" if m != 3 else "C", item_id=1 + (m == 2), item_title="x" if m != 2 else "y", created_at=f"2000-0{m}-05 00:00:00") for i, m in enumerate([1, 2, 3, 4, 5, 1, 2, 3, 4, 5])]
    partitioned.full_load(spark, make_raw(rows), root)
    stored_marts.build(spark, root, mart_root)
    return root, mart_root


def follow(spark, make_raw, small, rows, start="2000-05-20", end="2000-05-21"):
    root, mart_root = small
    before = manifest.current(spark, mart_root)
    partitioned.incremental_load(spark, make_raw(rows), start, end, root)
    months = stored_marts.maintain(spark, root, mart_root)
    after = manifest.current(spark, mart_root)
    for name in MARTS:
        assert same(stored_marts.read(spark, mart_root, name), rebuilt(spark, root, name)), name
        kept = {m: p for m, p in before.paths[name].items() if m not in months[name]}
        assert all(after.paths[name][m] == p for m, p in kept.items())
    return months


def test_a_changed_address_reaches_exactly_its_orders(spark, make_raw, small):
    root, _ = small
    months = follow(spark, make_raw, small, [row(100, store_id=2, store_address="Moved, x", item_id=1, created_at="2000-05-20 10:00:00")])
    assert months == {"mart_orders": ["2000-03-01", "2000-05-01"], "mart_products": ["2000-03-01", "2000-05-01"]}
    versions = [manifest.read(spark, root, v) for v in (1, 2)]
    reached = stored_marts.reached_orders(spark, *versions, [versions[1].info["delta"]])
    assert sorted(tuple(r) for r in reached.collect()) == [(2, False), (7, False), (100, False)]


def test_a_changed_title_reaches_only_the_mart_of_items(spark, make_raw, small):
    months = follow(spark, make_raw, small, [row(100, item_id=2, item_title="renamed", created_at="2000-05-20 10:00:00")])
    assert months == {"mart_orders": ["2000-05-01"], "mart_products": ["2000-02-01", "2000-05-01"]}


def test_an_unchanged_store_reaches_only_the_slice(spark, make_raw, small):
    assert follow(spark, make_raw, small, [row(100, created_at="2000-05-20 10:00:00")])["mart_products"] == ["2000-05-01"]


def test_an_update_of_an_old_order_and_two_loads_between(spark, make_raw, small):
    root, mart_root = small
    partitioned.incremental_load(spark, make_raw([row(5, address_text="new", created_at="2000-05-10 00:00:00")]), "2000-05-10", "2000-05-11", root)
    months = follow(spark, make_raw, small, [row(8, driver_id=9, created_at="2000-05-20 10:00:00")])
    assert months["mart_orders"] == ["2000-01-01", "2000-04-01"]


def test_full_loads_and_drained_versions_rebuild(spark, make_raw, small):
    root, mart_root = small
    partitioned.full_load(spark, make_raw([row(1)]), root)
    assert stored_marts.maintain(spark, root, mart_root)["mart_orders"] == ["2000-01-01"]
    assert stored_marts.read(spark, mart_root, "mart_orders").count() == 1
    for d in (20, 21):
        partitioned.incremental_load(spark, make_raw([row(d, created_at=f"2000-05-{d} 10:00:00")]), f"2000-05-{d}", f"2000-05-{d + 1}", root)
    manifest.drain(spark, root, keep=1, min_age_seconds=-10)
    assert stored_marts.maintain(spark, root, mart_root)["mart_orders"] == ["2000-01-01", "2000-05-01"]
    assert same(stored_marts.read(spark, mart_root, "mart_products"), rebuilt(spark, root, "mart_products"))


def test_a_failed_maintenance_changes_nothing(spark, make_raw, small, monkeypatch):
    root, mart_root = small
    partitioned.incremental_load(spark, make_raw([row(100, created_at="2000-05-20 10:00:00")]), "2000-05-20", "2000-05-21", root)
    before = manifest.current(spark, mart_root)
    monkeypatch.setattr(stored_marts, "_write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        stored_marts.maintain(spark, root, mart_root)
    monkeypatch.undo()
    assert manifest.current(spark, mart_root) == before
    assert stored_marts.maintain(spark, root, mart_root)["mart_orders"] == ["2000-05-01"]
    assert same(stored_marts.read(spark, mart_root, "mart_orders"), rebuilt(spark, root, "mart_orders"))


def test_order_slices_part_all_rows(spark, monkeypatch):
    ids = spark.range(1000).selectExpr("CASE WHEN id % 100 = 7 THEN NULL WHEN id < 300 THEN 5 ELSE id * 3 END AS order_id")
    assert partitioned.order_slices(ids) == ["true"]
    monkeypatch.setattr(partitioned, "ORDERS_AT_ONCE", 100)
    slices = partitioned.order_slices(ids)
    counts = [ids.filter(s).count() for s in slices]
    assert 5 < len(slices) <= 10 and sum(counts) == 1000 and sum(sorted(counts)[:-1]) <= 7 * 110
    beyond = spark.createDataFrame([(-(10**15),), (10**15,), (None,)], "order_id long")
    assert sum(beyond.filter(s).count() for s in slices) == 3
    assert partitioned.order_slices(ids.filter("order_id IS NULL").crossJoin(spark.range(90).drop("id"))) == ["true"]


def written(monkeypatch):
    """Rows of every write of a fact or mart, by table."""
    from lastmile.operators import checks

    seen, real = {}, checks.observed

    def observed(df, spec):
        out = real(df, spec)
        seen.setdefault(spec.name, []).append(out[1])
        return out

    monkeypatch.setattr(checks, "observed", observed)
    return lambda name: [int(o.get["rows"]) for o in seen.get(name, [])]


def test_facts_and_marts_are_written_by_slices_of_the_orders(spark, make_raw, tmp_path, monkeypatch):
    rows = [row(i, item_id=k, driver_id=k, created_at=f"2000-0{1 + i % 3}-05 00:00:00") for i in range(40) for k in (1, 2)]
    rows += [row(7, item_id=k, item_discount="2") for k in range(30, 40)]  # more than others, and not allowed
    again = [row(i, item_id=2, item_quantity=9, item_title="new", created_at="2000-05-20 10:00:00") for i in range(0, 60, 5)]
    tables = {}
    for at_once in (1000, 30):
        monkeypatch.setattr(partitioned, "ORDERS_AT_ONCE", at_once)
        root, mart_root = str(tmp_path / f"w{at_once}"), str(tmp_path / f"m{at_once}")
        rows_of = written(monkeypatch)
        report = partitioned.full_load(spark, make_raw(rows), root, strict=False)
        assert [r.violations for r in report.filter("constraint_name LIKE 'range%'").collect()] == [10]
        stored_marts.build(spark, root, mart_root)
        partitioned.incremental_load(spark, make_raw(again), "2000-05-20", "2000-05-21", root, strict=False, max_broadcast_bytes=0)
        stored_marts.maintain(spark, root, mart_root)
        for name in ("order_items", "order_driver_assignments", *MARTS):
            counts = rows_of(name)
            assert len(counts) == 2 if at_once == 1000 else len(counts) == 4 and max(counts) <= 75, (name, counts)
        for name in MARTS:
            assert same(stored_marts.read(spark, mart_root, name), rebuilt(spark, root, name)), name
        tables[at_once] = partitioned.read_tables(spark, root)
        monkeypatch.undo()
    for name in WAREHOUSE:
        assert same(tables[30][name], tables[1000][name]), name


@pytest.mark.parametrize("buckets", [0, 3])
def test_parts_written_in_slices(spark, tmp_path, buckets):
    from lastmile.sources.store import write_parts

    df = spark.range(60).selectExpr("concat('k', id) AS order_item_id", "id AS order_id", "id % 7 AS item_id", "1 AS item_quantity", "CAST(1 AS DECIMAL(12,2)) AS item_price", "NULL AS item_canceled_quantity",
                                    "CAST(CASE WHEN id % 20 = 0 THEN 2 END AS DECIMAL(5,4)) AS item_discount", "NULL AS item_replaced_id", "DATE'2000-01-01' + CAST(31 * (id % 2) AS INT) AS order_month")
    slices = (df.filter(s) for s in ("order_id < 25", "order_id >= 25 AND order_id < 50", "order_id >= 50", "order_id > 99"))
    parts, counted = write_parts(slices, str(tmp_path), WAREHOUSE["order_items"], "order_month", "order_id", buckets)
    assert sorted(parts) == ["2000-01-01", "2000-02-01"] and ("order_items", "non_empty", 0) in counted
    assert ("order_items", "range_item_discount_0_1", 3) in counted
    assert sorted(r.order_id for r in spark.read.parquet(*parts.values()).collect()) == list(range(60))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lastmile_load_")]


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    blocks = env.blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("name", ["mart_orders", "mart_products"])
def test_a_maintained_mart_leaves_only_what_is_published(spark, tmp_path, monkeypatch, name):
    """Shuffle files go with their action, the raw rows and replaced facts when they have been read."""
    from lastmile.plans import queries

    monkeypatch.setattr(queries, "ensure_checkpoint_dir", lambda _: str(tmp_path))
    codec = "spark.sql.parquet.compression.codec"
    settings = {k: spark.conf.get(k, None) for k in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", codec)}
    before = shuffle_files(spark)
    df = QUERIES[f"maintained_{name}"](spark, SF_SMALL)
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # they are removed beside the work
    assert not left
    (root,) = (str(p) for p in tmp_path.iterdir())
    assert sorted(os.listdir(root)) == ["dwh", "marts"]
    versions = [manifest.read(spark, f"{root}/dwh", v) for v in (1, 2)]
    for table in WAREHOUSE:
        for part, path in versions[0].paths[table].items():
            assert os.path.isdir(path) == (table not in partitioned.FACTS or versions[1].paths[table].get(part) == path), path
    assert manifest.current(spark, f"{root}/marts").info["delta"]  # maintained, not built again
    assert same(df, rebuilt(spark, f"{root}/dwh", name))
    assert {k: spark.conf.get(k, None) for k in settings} == settings


def test_the_raw_rows_are_given_up_once_the_slice_is_stored(spark, make_raw, small):
    root, mart_root = small
    make_raw([row(100, created_at="2000-05-20 10:00:00")]).write.parquet(f"{root}/raw")
    partitioned.incremental_load(spark, spark.read.parquet(f"{root}/raw"), "2000-05-20", "2000-05-21", root, raw_read=lambda: manifest.delete(spark, f"{root}/raw"))
    assert not os.path.exists(f"{root}/raw")
    assert partitioned.read_tables(spark, root)["orders"].filter("order_id = 100").count() == 1
    gone = manifest.release(spark, root, 1, partitioned.FACTS)
    assert len(gone) == 3 and not any(os.path.exists(f) for f in gone) and manifest.release(spark, root, 2, partitioned.FACTS) == []
    assert stored_marts.maintain(spark, root, mart_root)["mart_orders"] == ["2000-05-01"]
    assert same(stored_marts.read(spark, mart_root, "mart_products"), rebuilt(spark, root, "mart_products"))
