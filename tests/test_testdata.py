"""Raw rows from source tables with missing, null and repeated keys: what moves, and what comes."""

import os
import re

import pytest

from lastmile.plans.queries import QUERIES
from lastmile.schemas import RAW
from lastmile.sources import testdata

ROWS = {
    "region": "id AS r_regionkey, 'r' || id AS r_name FROM range(3)",
    "nation": "id AS n_nationkey, 'n' || id AS n_name, id % 4 AS n_regionkey FROM range(8)",
    # customer 7, part 5 and supplier 3 come twice; some keys of the facts are missing or null
    "customer": "CASE WHEN id = 900 THEN 7 ELSE id END AS c_custkey, 'c' || id AS c_name, id % 9 AS c_nationkey, 0 AS c_acctbal, 'm' || id % 3 AS c_mktsegment FROM range(901)",
    "supplier": "CASE WHEN id = 40 THEN 3 ELSE id END AS s_suppkey, 's' AS s_name, 0 AS s_nationkey, 0 AS s_acctbal FROM range(41)",
    "part": "CASE WHEN id = 900 THEN 5 ELSE id END AS p_partkey, 'p' || id AS p_name, 'b' AS p_brand, 't' || id % 5 AS p_type, 1 AS p_size, 900 + id % 7 AS p_retailprice FROM range(901)",
    "orders": "CASE WHEN id <> 11 THEN id END AS o_orderkey, CASE WHEN id % 50 <> 1 THEN id * 3 % 950 END AS o_custkey, substr('OFP', 1 + id % 3, 1) AS o_orderstatus, 0 AS o_totalprice, "
    "TIMESTAMP_NTZ'1999-06-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(1000)",
    "lineitem": "CASE WHEN id % 61 <> 0 THEN id DIV 3 END AS l_orderkey, id * 7 % 930 AS l_partkey, CASE WHEN id % 47 <> 0 THEN id % 42 END AS l_suppkey, 1 + id % 3 AS l_linenumber, 1 + id % 9 AS l_quantity, 0 AS l_extendedprice, "
    "0.25 AS l_discount, 0 AS l_tax, substr('NRA', 1 + id % 3, 1) AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ'2000-01-01 00:00:00' AS l_shipdate FROM range(3100)",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, sql in ROWS.items():
        df = spark.sql(f"SELECT {sql}")
        kinds = dict(c.strip().split(" ") for c in testdata.SCHEMAS[name].split(","))
        df.selectExpr(*[f"CAST({c} AS {k}) AS {c}" for c, k in kinds.items()]).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def sized(spark):
    """As at scale: only nation and region are under the broadcast threshold."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[0], "4k")
    spark.conf.set(names[1], "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _sorted(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def _exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


def test_raw_rows_are_the_plain_join(spark, tables):
    t = testdata.read_tables(spark, tables)
    on = {"orders": "l_orderkey = o_orderkey", "customer": "o_custkey = c_custkey", "nation": "c_nationkey = n_nationkey", "region": "n_regionkey = r_regionkey", "part": "l_partkey = p_partkey", "supplier": "l_suppkey = s_suppkey"}
    for name, df in t.items():
        df.createOrReplaceTempView(f"src_{name}")
    joins = " ".join(f"JOIN src_{n} ON {c}" for n, c in on.items())
    columns = ", ".join(f"{testdata.RAW_EXPRESSIONS[f.name]} AS {f.name}" for f in RAW.fields)
    plain = spark.sql(f"SELECT {columns} FROM (SELECT *, (SELECT count(*) FROM src_part) AS __part_count FROM src_lineitem {joins})")
    want = _sorted(testdata.conform(plain, RAW))
    assert len(want) > 1000 and _sorted(testdata.raw_from_tables(spark, tables)) == want
    assert _sorted(testdata.raw_from_tables(spark, tables, [(1,)])) == want
    stored = testdata.stored_raw(spark, tables)
    assert stored.columns == RAW.names and _sorted(stored) == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lastmile_rows")]
    few = testdata.stored_raw(spark, tables, item_names=False)
    assert set(RAW.names) - set(few.columns) == set(testdata.ITEM_NAMES)
    names = ["item_id", *testdata.ITEM_NAMES]
    items = testdata.raw_items(spark, tables, few).distinct()
    assert _sorted(items) == _sorted(stored.select(*names).distinct())


def test_lines_move_only_by_part_and_order(spark, tables, sized):
    """No customer or supplier key deals the lines out again; the order top-1 needs no shuffle."""
    found = _exchanges(QUERIES["dwh_orders"](spark, tables))
    assert sorted(found) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]


def test_stored_rows_are_joined_once_and_in_order_buckets(spark, tables, sized):
    found = _exchanges(QUERIES["mart_products"](spark, tables))
    assert not {"l_orderkey", "o_orderkey", "l_partkey", "o_custkey", "order_id", "store_id"} & set(found), found


def test_resent_rows_keep_the_partitioning(spark, tables, sized):
    raw = testdata.with_resent_rows(testdata.stored_raw(spark, tables))
    assert raw.columns == RAW.names
    plan = raw.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") <= 2, plan  # the rows once, and the count of parts


def test_raw_rows_stored_in_rounds_fill_the_same_buckets(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(testdata, "LINES_PER_TASK", 200)
    found = {}
    for at_once in (0, 500):
        path = str(tmp_path / f"raw{at_once}")
        raw = testdata.stored_raw(spark, tables, path=path, at_once=at_once)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        found[at_once] = raw, len({f.split("-", 2)[2].split(".")[0].split("_")[0] for f in files}), {f.rpartition("_")[2][:5] for f in files}
        assert len(files) == len({f.rpartition("_")[2][:5] for f in files})  # a bucket is one file
    assert found[0][0].exceptAll(found[500][0]).isEmpty() and found[500][0].exceptAll(found[0][0]).isEmpty()
    assert found[0][0].count() > 0 and found[0][1] == 1 and found[500][1] > 3 and found[0][2] == found[500][2]
