"""Raw order rows derived from the driver's TPC-H-like tables.

``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part ⋈ supplier`` (inner joins on
their keys, nation through the customer), one raw row per line item. The column
rules are fixed so the DuckDB oracle can rebuild the same table (see FIXTURES.md §4).

Join shape: what belongs to a line (part, supplier) joins the lines and what belongs to an
order (customer) joins the orders, so no dimension makes the widest rows move. Then lines meet
orders, sort-merged on the order key, and nation and region join where the rows are. Spark
broadcasts nation and region only when their size estimate is under the broadcast threshold,
and suppliers' keys are broadcast when, counted, they take at most ``BROADCAST_BYTES``.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.functions.conform import conform
from lastmile.operators.skew import default_share, hot_keys
from lastmile.schemas import RAW
from lastmile.session import ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Cancellation reason by order priority (FIXTURES.md §4).
REASON_BY_PRIORITY = {
    "1-URGENT": "Ошибка приложения",
    "5-LOW": "Проблемы с оплатой",
    "4-NOT SPECIFIED": "Другое",
}
USER_PHONE_PREFIX = "+7"
DRIVER_PHONE_PREFIX = "+8"
DELIVERY_COST_STEP = "25.50"


# Declared input schemas (FIXTURES.md §3): no footer inference job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(SCHEMAS[t]).parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES}


# Column rules of the raw table (FIXTURES.md §4), as Spark SQL expressions: one parse
# each, instead of one JVM round trip per Column-API call.
_CANCELED = (
    "o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', '5-LOW') AND l_linenumber >= 3"
)
_HAS_DRIVER = "l_quantity >= 3"
_STARTED = "l_linenumber <> 7"
RAW_EXPRESSIONS = {
    "order_id": "o_orderkey",
    "user_id": "o_custkey",
    "user_phone": f"'{USER_PHONE_PREFIX}' || lpad(CAST(c_custkey AS STRING), 10, '0')",
    "driver_id": f"CASE WHEN {_HAS_DRIVER} THEN l_suppkey END",
    "driver_phone": f"CASE WHEN {_HAS_DRIVER} THEN '{DRIVER_PHONE_PREFIX}' || lpad(CAST(s_suppkey AS STRING), 10, '0') END",
    "store_id": "CAST(c_nationkey AS BIGINT)",
    "store_address": "n_name || ', ' || r_name",
    "item_id": "l_partkey",
    "item_title": "p_name",
    "item_category": "p_type",
    "item_quantity": "CAST(l_quantity AS INT)",
    "item_price": "CAST(p_retailprice AS DECIMAL(12,2))",
    "item_canceled_quantity": "CASE l_returnflag WHEN 'R' THEN CAST(l_quantity AS INT) "
    "WHEN 'A' THEN CAST(floor(l_quantity / 2) AS INT) END",
    "item_discount": "CASE WHEN l_returnflag <> 'N' THEN CAST(l_discount AS DECIMAL(5,4)) END",
    "item_replaced_id": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN (l_partkey + 1) % __part_count END",
    "address_text": "c_name || ', ' || n_name",
    "created_at": "o_orderdate + make_dt_interval(10 * (l_linenumber - 1))",
    "paid_at": "CASE WHEN o_orderstatus IN ('F', 'P') AND l_linenumber >= 2 THEN o_orderdate + INTERVAL 10 MINUTES END",
    "canceled_at": f"CASE WHEN {_CANCELED} THEN o_orderdate + INTERVAL 2 DAYS END",
    "payment_type": "c_mktsegment",
    "order_discount": "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(10 * (o_orderkey % 5) AS INT) END",
    "order_cancellation_reason": f"CASE WHEN {_CANCELED} THEN CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{r}'" for p, r in REASON_BY_PRIORITY.items())
    + " END END",
    "delivery_cost": "CASE WHEN (o_orderkey + l_linenumber) % 7 <> 0 "
    f"THEN CAST(((o_orderkey + l_linenumber) % 7) * {DELIVERY_COST_STEP}BD AS DECIMAL(12,2)) END",
    "delivery_started_at": f"CASE WHEN {_STARTED} THEN l_shipdate END",
    "delivered_at": f"CASE WHEN {_STARTED} AND l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 HOURS END",
}


#: Lines of one task in the join by order id, whatever the input's size.
LINES_PER_TASK = 250_000
#: Lines that ``stored_raw`` joins at a time where disk is short.
LINES_AT_ONCE = 64_000_000
#: Suppliers' keys of at most so many bytes (24 a row) are broadcast.
BROADCAST_BYTES = 64 << 20
#: Raw columns that only an item's part knows.
ITEM_NAMES = ("item_title", "item_category")


def hot_order_ids(spark: SparkSession, sf_dir: str) -> list:
    """Orders that hold a large share of the lines, or are there very often: found in the key
    columns of the two tables, before any join."""
    t = read_tables(spark, sf_dir)
    keys = [t["lineitem"].selectExpr("l_orderkey AS order_id"), t["orders"].selectExpr("o_orderkey AS order_id")]
    return list(dict.fromkeys(k for df in keys for k in hot_keys(df.filter("order_id IS NOT NULL"), ["order_id"], default_share(df))))


def order_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks of the join by order id: as many as the lines fill, and one for each core."""
    lines = read_tables(spark, sf_dir)["lineitem"].count()
    return max(spark.sparkContext.defaultParallelism, math.ceil(lines / LINES_PER_TASK))


def joined_rows(spark: SparkSession, sf_dir: str, tasks: int = 0, item_names: bool = True, some: tuple[int, int] | None = None) -> DataFrame:
    """The source columns of one raw row each; with ``tasks``, dealt by order id to so many, or
    only the rows of ``some`` of them (the first, and the one after the last).

    Parts and customers, the smaller sides, are hashed, so the lines and orders that meet them
    aren't sorted. The two fact-sized tables are sort-merge joined on the order key (the plan Spark picks
    for them at scale anyway, stated as a hint so small inputs get it too). The rows come
    out hash-partitioned by order id, which the order-keyed windows and aggregations
    downstream reuse without a re-shuffle.
    """
    t = read_tables(spark, sf_dir)
    if some:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            t[name] = t[name].filter(f"pmod(hash({key}), {tasks}) >= {some[0]} AND pmod(hash({key}), {tasks}) < {some[1]}")
    suppliers = t["supplier"].select("s_suppkey")
    if 24 * suppliers.count() <= BROADCAST_BYTES:
        suppliers = F.broadcast(suppliers)
    parts = t["part"] if item_names else t["part"].drop("p_name", "p_type")
    lines = t["lineitem"].join(suppliers, F.expr("l_suppkey = s_suppkey")).join(parts.hint("shuffle_hash"), F.expr("l_partkey = p_partkey"))
    placed = t["orders"].join(t["customer"].hint("shuffle_hash"), F.expr("o_custkey = c_custkey"))
    if tasks:
        lines, placed = lines.repartition(tasks, "l_orderkey"), placed.repartition(tasks, "o_orderkey")
    rows = lines.join(placed.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    # one after the other: Spark takes the size of two tables' join for the product of theirs
    return rows.join(t["nation"], F.expr("c_nationkey = n_nationkey")).join(t["region"], F.expr("n_regionkey = r_regionkey"))


def _raw_of(rows: DataFrame, part: DataFrame) -> DataFrame:
    """Raw rows from their source columns (without the item's names, if those lack them)."""
    named = {"p_name", "p_type"} <= set(rows.columns)
    schema = T.StructType([f for f in RAW.fields if named or f.name not in ITEM_NAMES])
    counted = rows.withColumn("__part_count", part.select(F.count(F.lit(1))).scalar())
    return conform(counted.selectExpr(*[f"{RAW_EXPRESSIONS[f.name]} AS {f.name}" for f in schema.fields]), schema)


def raw_from_tables(spark: SparkSession, sf_dir: str, hot: list | None = None) -> DataFrame:
    """The raw rows, derived when they are read. ``hot`` lists the orders of very many lines,
    if the caller knows them: with some, adaptive execution sizes and splits the join's tasks."""
    hot = hot_order_ids(spark, sf_dir) if hot is None else hot
    rows = joined_rows(spark, sf_dir, 0 if hot else order_tasks(spark, sf_dir))
    return _raw_of(rows, read_tables(spark, sf_dir)["part"])


#: What raw rows are made from (the keys that equal another one aren't stored twice).
_STORED = {
    "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "c_custkey": "o_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey",
    "c_mktsegment": "c_mktsegment", "o_orderstatus": "o_orderstatus", "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority",
    "n_name": "n_name", "r_name": "r_name", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "s_suppkey": "l_suppkey",
    "l_linenumber": "l_linenumber", "l_quantity": "l_quantity", "l_discount": "l_discount", "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus", "l_shipdate": "l_shipdate", "p_retailprice": "p_retailprice", "p_name": "p_name", "p_type": "p_type",
}


def stored_raw(spark: SparkSession, sf_dir: str, item_names: bool = True, path: str = "", at_once: int = 0) -> DataFrame:
    """The raw rows for work that reads them more than once: joined once, and written under
    the checkpoint folder (or to ``path``) in buckets of the order id.

    Every read takes the columns it needs, and order-keyed work on them needs no shuffle.
    Without ``item_names`` the rows lack the title and category that ``raw_items`` gives.
    With ``at_once`` the buckets are filled a few after the others, about so many lines at a
    time: every round reads the source tables, and shuffle files are a round's.
    Spark writes buckets only as a table, so an external one stands in the catalog until the
    rows are read from its files.
    """
    tasks = order_tasks(spark, sf_dir)
    name = f"lastmile_rows_{uuid.uuid4().hex}"
    columns = [c for c in dict.fromkeys(_STORED.values()) if item_names or c not in ("p_name", "p_type")]
    rounds = min(tasks, math.ceil(tasks * LINES_PER_TASK / at_once)) if at_once else 1
    ends = [tasks * k // rounds for k in range(rounds + 1)]
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    try:
        for some in zip(ends, ends[1:]):
            rows = joined_rows(spark, sf_dir, tasks, item_names, some if rounds > 1 else None).select(*columns)
            rows.write.mode("append").format("parquet").bucketBy(tasks, "o_orderkey").sortBy("o_orderkey").option("path", path).saveAsTable(name)
        found = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    found = found.selectExpr(*[f"{stored} AS {column}" for column, stored in _STORED.items() if stored in columns])
    return _raw_of(found, read_tables(spark, sf_dir)["part"])


def raw_items(spark: SparkSession, sf_dir: str, raw: DataFrame) -> DataFrame:
    """(item_id, item_title, item_category) of the items in ``raw``: of each, every variant
    that raw rows show, once for each of its rows in ``part``."""
    found = raw.select("item_id").distinct()
    items = read_tables(spark, sf_dir)["part"].join(found, F.expr("p_partkey = item_id"), "left_semi")
    return items.selectExpr("p_partkey AS item_id", *[f"{RAW_EXPRESSIONS[c]} AS {c}" for c in ITEM_NAMES])


# Rows of the slice as a later run would send them (FIXTURES.md §4): attributes of
# dimensions change or go missing, and a tenth of the earlier orders is sent again.
IN_SLICE = "created_at >= TIMESTAMP_NTZ'2000-01-01 00:00:00' AND created_at < TIMESTAMP_NTZ'2000-07-01 00:00:00'"
CHANGED = {
    "user_phone": "CASE user_id % 3 WHEN 0 THEN '+0' || substr(user_phone, 3) WHEN 1 THEN NULL ELSE user_phone END",
    "driver_phone": "CASE driver_id % 3 WHEN 0 THEN '+0' || substr(driver_phone, 3) WHEN 1 THEN NULL ELSE driver_phone END",
    "store_address": "CASE WHEN store_id % 2 = 0 THEN '*' || store_address ELSE store_address END",
    "item_title": "CASE WHEN item_id % 3 = 0 THEN '*' || item_title ELSE item_title END",
    "item_category": "CASE WHEN item_id % 4 = 0 THEN NULL ELSE item_category END",
}
RESENT = {
    "created_at": "TIMESTAMP_NTZ'2000-02-01 00:00:00' + make_dt_interval(CAST(order_id % 28 AS INT))",
    "payment_type": "CASE WHEN order_id % 20 = 0 THEN NULL ELSE payment_type END",
    "item_quantity": "item_quantity + 1",
    "item_canceled_quantity": "CAST(NULL AS INT)",
    "item_discount": "CASE WHEN item_id % 2 = 0 THEN CAST(0.05 AS DECIMAL(5,4)) END",
    "delivered_at": "CASE WHEN order_id % 20 <> 0 THEN delivered_at + INTERVAL 1 DAY END",
}

# Rows that break constraints (FIXTURES.md §4).
FLAWED = {
    "created_at": "CASE WHEN order_id % 50 <> 7 THEN created_at END",
    "user_id": "CASE WHEN order_id % 60 <> 1 THEN user_id END",
    "store_id": "CASE WHEN order_id % 70 <> 2 THEN store_id END",
    "store_address": "CASE WHEN store_id <> 3 THEN store_address END",
    "item_title": "CASE WHEN item_id % 40 <> 0 THEN item_title END",
    "item_discount": "CASE WHEN order_id % 30 = 3 THEN CAST(1.5 AS DECIMAL(5,4)) ELSE item_discount END",
    "item_replaced_id": "CASE WHEN order_id % 25 = 4 THEN item_replaced_id + 1000000000 ELSE item_replaced_id END",
}


def _replaced(raw: DataFrame, rules: dict[str, str], when: str | None = None) -> DataFrame:
    def sql(name: str) -> str:
        if name not in rules:
            return name
        return f"{rules[name]} AS {name}" if when is None else f"CASE WHEN {when} THEN {rules[name]} ELSE {name} END AS {name}"

    schema = T.StructType([f for f in RAW.fields if f.name in raw.columns])
    others = [c for c in raw.columns if c not in RAW.names]
    replaced = raw.selectExpr(*others, *[sql(f.name) for f in schema.fields])
    return replaced if others else conform(replaced, schema)


def with_resent_rows(raw: DataFrame) -> DataFrame:
    """``raw`` with the slice's attributes changed and earlier orders sent again in it.

    A row that is sent again becomes two where it is, so ``raw`` is read once and stays
    partitioned as it was.
    """
    again = "created_at < TIMESTAMP_NTZ'2000-01-01 00:00:00' AND order_id % 10 = 0"
    sent = raw.withColumn("__again", F.expr(f"explode(CASE WHEN {again} THEN array(false, true) ELSE array(false) END)"))
    return _replaced(conform(_replaced(sent, RESENT, "__again").drop("__again"), raw.schema), CHANGED, IN_SLICE)


def flawed_rows(raw: DataFrame) -> DataFrame:
    """``raw`` with nulls, orphans and discounts that the constraints forbid."""
    return _replaced(raw, FLAWED)
