"""DuckDB SQL restating every registered query, for the side-by-side correctness check.

The driver's TPC-H-like tables are registered as views (``orders`` there is the
TPC-H orders table, so warehouse tables get a prefix here: ``w_``, ``b_``, ``d_``).
Money columns are cast to DOUBLE on both sides after exact decimal arithmetic.
"""

from __future__ import annotations

from types import SimpleNamespace as _Spec

# The tables' columns, keys, updatable columns, NOT NULLs and references, stated
# here again so that a wrong list in the package shows as a difference.
WAREHOUSE = {
    "users": _Spec(columns=["user_id", "user_phone"], pk="user_id", updatable=["user_phone"], not_null=[], references=[]),
    "drivers": _Spec(columns=["driver_id", "driver_phone"], pk="driver_id", updatable=["driver_phone"], not_null=[], references=[]),
    "stores": _Spec(columns=["store_id", "store_address"], pk="store_id", updatable=["store_address"], not_null=["store_address"], references=[]),
    "products": _Spec(
        columns=["item_id", "item_title", "item_category"], pk="item_id", updatable=["item_title", "item_category"], not_null=["item_title"], references=[]
    ),
    "orders": _Spec(
        columns=["order_id", "user_id", "store_id", "address_text", "created_at", "paid_at", "canceled_at", "payment_type", "order_discount",
                 "order_cancellation_reason", "delivery_cost"],
        pk="order_id",
        updatable=["address_text", "paid_at", "canceled_at", "payment_type", "order_discount", "order_cancellation_reason", "delivery_cost"],
        not_null=["user_id", "store_id", "created_at"],
        references=[("user_id", "users", "user_id"), ("store_id", "stores", "store_id")],
    ),
    "order_items": _Spec(
        columns=["order_item_id", "order_id", "item_id", "item_quantity", "item_price", "item_canceled_quantity", "item_discount", "item_replaced_id"],
        pk="order_item_id",
        updatable=["item_quantity", "item_price", "item_canceled_quantity", "item_discount", "item_replaced_id"],
        not_null=["order_id", "item_id"],
        references=[("order_id", "orders", "order_id"), ("item_id", "products", "item_id"), ("item_replaced_id", "products", "item_id")],
    ),
    "order_driver_assignments": _Spec(
        columns=["assignment_id", "order_id", "driver_id", "delivery_started_at", "delivered_at"],
        pk="assignment_id",
        updatable=["delivery_started_at", "delivered_at"],
        not_null=["order_id", "driver_id"],
        references=[("order_id", "orders", "order_id"), ("driver_id", "drivers", "driver_id")],
    ),
}
RAW_COLUMNS = [
    "order_id", "user_id", "user_phone", "driver_id", "driver_phone", "store_id", "store_address", "item_id", "item_title", "item_category",
    "item_quantity", "item_price", "item_canceled_quantity", "item_discount", "item_replaced_id", "address_text", "created_at", "paid_at",
    "canceled_at", "payment_type", "order_discount", "order_cancellation_reason", "delivery_cost", "delivery_started_at", "delivered_at",
]

SLICE_START = "TIMESTAMP '2000-01-01 00:00:00'"
SLICE_END = "TIMESTAMP '2000-07-01 00:00:00'"

RAW = """
raw AS (
  SELECT
    o.o_orderkey AS order_id,
    o.o_custkey AS user_id,
    '+7' || lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') AS user_phone,
    CASE WHEN l.l_quantity >= 3 THEN l.l_suppkey END AS driver_id,
    CASE WHEN l.l_quantity >= 3 THEN '+8' || lpad(CAST(s.s_suppkey AS VARCHAR), 10, '0') END AS driver_phone,
    CAST(c.c_nationkey AS BIGINT) AS store_id,
    n.n_name || ', ' || r.r_name AS store_address,
    l.l_partkey AS item_id,
    p.p_name AS item_title,
    p.p_type AS item_category,
    CAST(l.l_quantity AS INTEGER) AS item_quantity,
    CAST(p.p_retailprice AS DECIMAL(12,2)) AS item_price,
    CASE l.l_returnflag
      WHEN 'R' THEN CAST(l.l_quantity AS INTEGER)
      WHEN 'A' THEN CAST(floor(l.l_quantity / 2) AS INTEGER)
    END AS item_canceled_quantity,
    CASE WHEN l.l_returnflag <> 'N' THEN CAST(l.l_discount AS DECIMAL(5,4)) END AS item_discount,
    CASE WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F'
      THEN (l.l_partkey + 1) % (SELECT count(*) FROM part) END AS item_replaced_id,
    c.c_name || ', ' || n.n_name AS address_text,
    o.o_orderdate + to_days(CAST(10 * (l.l_linenumber - 1) AS INTEGER)) AS created_at,
    CASE WHEN o.o_orderstatus IN ('F', 'P') AND l.l_linenumber >= 2
      THEN o.o_orderdate + INTERVAL 10 MINUTE END AS paid_at,
    CASE WHEN o.o_orderstatus = 'O' AND o.o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', '5-LOW')
           AND l.l_linenumber >= 3
      THEN o.o_orderdate + INTERVAL 2 DAY END AS canceled_at,
    c.c_mktsegment AS payment_type,
    CASE WHEN o.o_orderkey % 5 <> 0 THEN CAST(10 * (o.o_orderkey % 5) AS INTEGER) END AS order_discount,
    CASE WHEN (o.o_orderkey + l.l_linenumber) % 7 <> 0
      THEN CAST(25.50 * ((o.o_orderkey + l.l_linenumber) % 7) AS DECIMAL(12,2)) END AS delivery_cost,
    CASE WHEN o.o_orderstatus = 'O' AND l.l_linenumber >= 3 THEN
      CASE o.o_orderpriority
        WHEN '1-URGENT' THEN 'Ошибка приложения'
        WHEN '5-LOW' THEN 'Проблемы с оплатой'
        WHEN '4-NOT SPECIFIED' THEN 'Другое'
      END
    END AS order_cancellation_reason,
    CASE WHEN l.l_linenumber <> 7 THEN l.l_shipdate END AS delivery_started_at,
    CASE WHEN l.l_linenumber <> 7 AND l.l_linestatus = 'F' THEN l.l_shipdate + INTERVAL 2 HOUR END AS delivered_at
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw_base AS (SELECT * FROM raw WHERE created_at < {start}),
raw_delta AS (SELECT * FROM raw WHERE created_at >= {start} AND created_at < {end})
""".format(start=SLICE_START, end=SLICE_END)

IN_SLICE = f"created_at >= {SLICE_START} AND created_at < {SLICE_END}"

# The slice as sent later: earlier orders again, attributes of dimensions changed.
SENT = f"""
sent AS (
  SELECT * REPLACE (
    CASE WHEN {IN_SLICE} THEN CASE user_id % 3 WHEN 0 THEN '+0' || substr(user_phone, 3) WHEN 1 THEN NULL ELSE user_phone END
         ELSE user_phone END AS user_phone,
    CASE WHEN {IN_SLICE} THEN CASE driver_id % 3 WHEN 0 THEN '+0' || substr(driver_phone, 3) WHEN 1 THEN NULL ELSE driver_phone END
         ELSE driver_phone END AS driver_phone,
    CASE WHEN {IN_SLICE} AND store_id % 2 = 0 THEN '*' || store_address ELSE store_address END AS store_address,
    CASE WHEN {IN_SLICE} AND item_id % 3 = 0 THEN '*' || item_title ELSE item_title END AS item_title,
    CASE WHEN {IN_SLICE} AND item_id % 4 = 0 THEN NULL ELSE item_category END AS item_category
  ) FROM (
    SELECT * FROM raw
    UNION ALL BY NAME
    SELECT * REPLACE (
      TIMESTAMP '2000-02-01 00:00:00' + to_days(CAST(order_id % 28 AS INTEGER)) AS created_at,
      CASE WHEN order_id % 20 = 0 THEN NULL ELSE payment_type END AS payment_type,
      item_quantity + 1 AS item_quantity,
      CAST(NULL AS INTEGER) AS item_canceled_quantity,
      CASE WHEN item_id % 2 = 0 THEN CAST(0.05 AS DECIMAL(5,4)) END AS item_discount,
      CASE WHEN order_id % 20 <> 0 THEN delivered_at + INTERVAL 1 DAY END AS delivered_at
    ) FROM raw_base WHERE order_id % 10 = 0
  )
),
sent_base AS (SELECT * FROM sent WHERE created_at < {SLICE_START}),
sent_delta AS (SELECT * FROM sent WHERE {IN_SLICE})
"""

# Rows that break constraints.
FLAWED = f"""
flawed AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 50 <> 7 THEN created_at END AS created_at,
    CASE WHEN order_id % 60 <> 1 THEN user_id END AS user_id,
    CASE WHEN order_id % 70 <> 2 THEN store_id END AS store_id,
    CASE WHEN store_id <> 3 THEN store_address END AS store_address,
    CASE WHEN item_id % 40 <> 0 THEN item_title END AS item_title,
    CASE WHEN order_id % 30 = 3 THEN CAST(1.5 AS DECIMAL(5,4)) ELSE item_discount END AS item_discount,
    CASE WHEN order_id % 25 = 4 THEN item_replaced_id + 1000000000 ELSE item_replaced_id END AS item_replaced_id
  ) FROM raw
),
flawed_early AS (SELECT * FROM flawed WHERE created_at < {SLICE_START})
"""

MONEY = {
    "raw": ["item_price", "item_discount", "delivery_cost"],
    "orders": ["delivery_cost"],
    "order_items": ["item_price", "item_discount"],
}


def _asc(cols) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


def _warehouse(src: str, p: str) -> str:
    """CTEs ``{p}users`` ... ``{p}order_driver_assignments`` built from CTE ``src``."""
    orders_cols = WAREHOUSE["orders"].columns
    orders_rest = [c for c in orders_cols if c not in ("order_id", "created_at")]
    item_vals = ["item_quantity", "item_price", "item_canceled_quantity", "item_discount", "item_replaced_id"]
    return f"""
{p}users AS (
  SELECT user_id, user_phone FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY user_phone ASC NULLS LAST) AS rn
    FROM (SELECT DISTINCT user_id, user_phone FROM {src} WHERE user_id IS NOT NULL)
  ) WHERE rn = 1
),
{p}drivers AS (
  SELECT driver_id, driver_phone FROM (
    SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY driver_phone ASC NULLS LAST) AS rn
    FROM (SELECT DISTINCT driver_id, driver_phone FROM {src} WHERE driver_id IS NOT NULL)
  ) WHERE rn = 1
),
{p}stores AS (
  SELECT store_id, store_address FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY store_address ASC NULLS LAST) AS rn
    FROM (SELECT DISTINCT store_id, store_address FROM {src} WHERE store_id IS NOT NULL)
  ) WHERE rn = 1
),
{p}products AS (
  SELECT item_id, item_title, item_category FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id
                                 ORDER BY item_title ASC NULLS LAST, item_category ASC NULLS LAST) AS rn
    FROM (SELECT DISTINCT item_id, item_title, item_category FROM {src} WHERE item_id IS NOT NULL)
  ) WHERE rn = 1
),
{p}orders AS (
  SELECT {", ".join(orders_cols)} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
                                 ORDER BY created_at DESC NULLS LAST, {_asc(orders_rest)}) AS rn
    FROM {src} WHERE order_id IS NOT NULL
  ) WHERE rn = 1
),
{p}order_items AS (
  SELECT CAST(order_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) || '_' || CAST(rn AS VARCHAR) AS order_item_id,
         order_id, item_id, {", ".join(item_vals)}
  FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, item_id
                                 ORDER BY created_at ASC NULLS LAST, {_asc(item_vals)}) AS rn
    FROM {src} WHERE order_id IS NOT NULL AND item_id IS NOT NULL
  )
),
{p}order_driver_assignments AS (
  SELECT CAST(order_id AS VARCHAR) || '_' || CAST(driver_id AS VARCHAR) || '_'
           || coalesce(CAST(delivery_started_at AS VARCHAR), 'no_start') AS assignment_id,
         order_id, driver_id, delivery_started_at, delivered_at
  FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, driver_id, delivery_started_at
                                 ORDER BY created_at DESC NULLS LAST, delivered_at ASC NULLS LAST) AS rn
    FROM {src} WHERE order_id IS NOT NULL AND driver_id IS NOT NULL
  ) WHERE rn = 1
)"""


def _select(table: str, cte: str) -> str:
    """All columns of a warehouse-shaped CTE, money as DOUBLE."""
    cols = WAREHOUSE[table].columns if table in WAREHOUSE else None
    money = MONEY.get(table, [])
    out = [f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols]
    return f"SELECT {', '.join(out)} FROM {cte}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


def _merged_rows(table: str, money: list[str]) -> str:
    """SELECT of base rows ``b_*`` with the slice's ``d_*`` upserted; ``money`` as DOUBLE."""
    spec = WAREHOUSE[table]
    cols = []
    for c in spec.columns:
        if c == spec.pk:
            expr = f"coalesce(b.{c}, d.{c})"
        elif c in spec.updatable:
            expr = f"CASE WHEN d.{spec.pk} IS NOT NULL THEN d.{c} ELSE b.{c} END"
        else:
            expr = f"CASE WHEN b.{spec.pk} IS NOT NULL THEN b.{c} ELSE d.{c} END"
        cols.append(f"CAST({expr} AS DOUBLE) AS {c}" if c in money else f"{expr} AS {c}")
    return f"SELECT {', '.join(cols)} FROM b_{table} b FULL OUTER JOIN d_{table} d ON b.{spec.pk} = d.{spec.pk}"


_MERGE_HEAD = (RAW, SENT, _warehouse("sent_base", "b_"), _warehouse("sent_delta", "d_"))


def _merged(table: str) -> str:
    return _with(*_MERGE_HEAD) + _merged_rows(table, MONEY.get(table, []))


MART_CTES = """
orders_calendar AS (
  SELECT *, CAST(created_at AS DATE) AS order_date,
         CAST(year(created_at) AS INTEGER) AS order_year,
         CAST(month(created_at) AS INTEGER) AS order_month,
         CAST(day(created_at) AS INTEGER) AS order_day
  FROM w_orders
),
items_enriched AS (
  SELECT order_item_id, order_id, item_id,
         q AS item_quantity, p AS item_price, c AS item_canceled_quantity, d AS item_discount,
         item_replaced_id,
         q - c AS item_paid_quantity,
         q * p AS gross_amount,
         q * p * d AS discount_amount,
         q * p * (1 - d) AS turnover_amount,
         c * p * (1 - d) AS canceled_amount,
         (q - c) * p * (1 - d) AS revenue_amount
  FROM (
    SELECT *, coalesce(item_quantity, 0) AS q, coalesce(item_canceled_quantity, 0) AS c,
           coalesce(item_price, 0) AS p, coalesce(item_discount, 0) AS d
    FROM w_order_items
  )
),
items_agg AS (
  SELECT order_id,
         CAST(sum(item_quantity) AS INTEGER) AS total_items_count,
         CAST(sum(item_canceled_quantity) AS INTEGER) AS canceled_items_count,
         CAST(sum(item_paid_quantity) AS INTEGER) AS paid_items_count,
         round(sum(gross_amount), 2) AS items_gross_amount,
         round(sum(discount_amount), 2) AS items_discount_amount,
         round(sum(turnover_amount), 2) AS items_turnover_amount,
         round(sum(canceled_amount), 2) AS items_canceled_amount,
         round(sum(revenue_amount), 2) AS paid_items_amount
  FROM items_enriched GROUP BY order_id
),
assignment_agg AS (
  SELECT order_id,
         min(delivery_started_at) AS first_delivery_started_at,
         max(delivered_at) AS delivered_at,
         CAST(count(DISTINCT driver_id) AS INTEGER) AS assigned_driver_count
  FROM w_order_driver_assignments GROUP BY order_id
),
first_driver AS (
  SELECT order_id, driver_id, delivered_at FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY delivery_started_at ASC NULLS LAST,
                                 delivered_at ASC NULLS LAST, driver_id ASC NULLS LAST) AS rn
    FROM w_order_driver_assignments
  ) WHERE rn = 1
)
"""

SERVICE = "('Ошибка приложения', 'Проблемы с оплатой')"


def _m(expr: str, name: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(14,2)) AS DOUBLE) AS {name}"


MART_ORDERS = f"""
SELECT o.order_id, o.user_id, o.store_id, o.order_date, o.order_year, o.order_month, o.order_day,
  trim(split_part(s.store_address, ',', 1)) AS city,
  s.store_address, o.address_text AS delivery_address, o.payment_type, o.order_cancellation_reason,
  o.created_at, o.paid_at, o.canceled_at, a.first_delivery_started_at, a.delivered_at,
  {_m("round(coalesce(CAST(o.order_discount AS DECIMAL(10,0)), 0), 2)", "order_discount")},
  {_m("round(coalesce(o.delivery_cost, 0), 2)", "delivery_cost")},
  coalesce(i.total_items_count, 0) AS total_items_count,
  coalesce(i.canceled_items_count, 0) AS canceled_items_count,
  coalesce(i.paid_items_count, 0) AS paid_items_count,
  {_m("round(coalesce(i.items_gross_amount, 0), 2)", "items_gross_amount")},
  {_m("round(coalesce(i.items_discount_amount, 0), 2)", "items_discount_amount")},
  {_m("round(coalesce(i.items_turnover_amount, 0), 2)", "items_turnover_amount")},
  {_m("round(coalesce(i.items_canceled_amount, 0), 2)", "items_canceled_amount")},
  {_m("round(coalesce(i.paid_items_amount, 0), 2)", "paid_items_amount")},
  {_m("round(coalesce(i.items_turnover_amount, 0) - coalesce(CAST(o.order_discount AS DECIMAL(10,0)), 0), 2)",
      "turnover_amount")},
  {_m("round(coalesce(i.paid_items_amount, 0) - coalesce(CAST(o.order_discount AS DECIMAL(10,0)), 0)"
      " + coalesce(o.delivery_cost, 0), 2)", "revenue_amount")},
  {_m("round(coalesce(i.paid_items_amount, 0) - coalesce(CAST(o.order_discount AS DECIMAL(10,0)), 0)"
      " + coalesce(o.delivery_cost, 0), 2)", "profit_amount")},
  1 AS created_order_flag,
  CASE WHEN a.delivered_at IS NOT NULL THEN 1 ELSE 0 END AS delivered_order_flag,
  CASE WHEN o.canceled_at IS NOT NULL THEN 1 ELSE 0 END AS canceled_order_flag,
  CASE WHEN o.canceled_at IS NOT NULL AND a.delivered_at IS NOT NULL THEN 1 ELSE 0 END
    AS canceled_after_delivery_flag,
  CASE WHEN o.order_cancellation_reason IN {SERVICE} THEN 1 ELSE 0 END AS service_cancel_flag,
  coalesce(a.assigned_driver_count, 0) AS assigned_driver_count,
  CASE WHEN coalesce(a.assigned_driver_count, 0) > 1 THEN 1 ELSE 0 END AS courier_changed_flag,
  CASE WHEN coalesce(a.assigned_driver_count, 0) > 0 THEN 1 ELSE 0 END AS active_driver_flag
FROM orders_calendar o
LEFT JOIN items_agg i ON o.order_id = i.order_id
LEFT JOIN assignment_agg a ON o.order_id = a.order_id
LEFT JOIN w_stores s ON o.store_id = s.store_id
"""

MART_PRODUCTS = f"""
SELECT oi.order_item_id, oi.order_id, o.user_id, o.store_id, fd.driver_id,
  oi.item_id AS product_id, oi.item_replaced_id AS replaced_product_id,
  p.item_title AS product_title, p.item_category AS product_category,
  o.order_date, o.order_year, o.order_month, o.order_day,
  trim(split_part(s.store_address, ',', 1)) AS city, s.store_address,
  o.payment_type, o.order_cancellation_reason, o.created_at, o.paid_at, o.canceled_at, fd.delivered_at,
  oi.item_quantity, oi.item_canceled_quantity, oi.item_paid_quantity,
  {_m("round(oi.item_price, 2)", "item_price")},
  {_m("round(oi.item_discount, 2)", "item_discount")},
  {_m("round(oi.gross_amount, 2)", "gross_amount")},
  {_m("round(oi.discount_amount, 2)", "discount_amount")},
  {_m("round(oi.turnover_amount, 2)", "turnover_amount")},
  {_m("round(oi.canceled_amount, 2)", "canceled_amount")},
  {_m("round(oi.revenue_amount, 2)", "revenue_amount")},
  1 AS created_order_flag,
  CASE WHEN fd.delivered_at IS NOT NULL THEN 1 ELSE 0 END AS delivered_order_flag,
  CASE WHEN o.canceled_at IS NOT NULL THEN 1 ELSE 0 END AS canceled_order_flag,
  CASE WHEN o.order_cancellation_reason IN {SERVICE} THEN 1 ELSE 0 END AS service_cancel_flag,
  CASE WHEN oi.item_canceled_quantity > 0 THEN 1 ELSE 0 END AS item_has_cancellation_flag
FROM items_enriched oi
LEFT JOIN orders_calendar o ON oi.order_id = o.order_id
LEFT JOIN first_driver fd ON oi.order_id = fd.order_id
LEFT JOIN w_stores s ON o.store_id = s.store_id
LEFT JOIN w_products p ON oi.item_id = p.item_id
"""

ENRICHED_MONEY = ["item_price", "item_discount", "gross_amount", "discount_amount", "turnover_amount",
                  "canceled_amount", "revenue_amount"]
AGG_MONEY = ["items_gross_amount", "items_discount_amount", "items_turnover_amount", "items_canceled_amount",
             "paid_items_amount"]


def _flawed_tables() -> str:
    """CTEs ``w_*``: dimensions of early rows, orders without every ninth, some keys twice."""
    out = [_warehouse("flawed", "f_"), _warehouse("flawed_early", "e_")]
    for t, s in WAREHOUSE.items():
        number = "order_id" if "order_id" in s.columns else s.pk
        source = f"e_{t}" if t in ("users", "drivers", "stores", "products") else f"f_{t}"
        some = "(SELECT * FROM f_orders WHERE order_id % 9 <> 0)" if t == "orders" else source
        out.append(f"w_{t} AS (SELECT * FROM {some} UNION ALL SELECT * FROM {some} WHERE {number} % 11 = 0)")
    return ",\n".join(x.strip().rstrip(",") for x in out)


def _checks() -> dict[str, str]:
    tables = list(WAREHOUSE)
    nonempty = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'non_empty' AS constraint_name, "
        f"CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM w_{t}" + (" WHERE store_id < 0" if t == "stores" else "")
        for t in tables
    )
    pks = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'pk_{s.pk}' AS constraint_name, "
        f"CAST(coalesce(sum(CASE WHEN k IS NULL THEN n ELSE n - 1 END), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {s.pk} AS k, count(*) AS n FROM w_{t} GROUP BY {s.pk})"
        for t, s in WAREHOUSE.items()
    )
    fks = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'fk_{column}_{parent}' AS constraint_name, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {column} AS k, count(*) AS n FROM w_{t} WHERE {column} IS NOT NULL "
        f"GROUP BY {column}) x "
        f"WHERE NOT EXISTS (SELECT 1 FROM w_{parent} par WHERE par.{key} = x.k)"
        for t, s in WAREHOUSE.items()
        for column, parent, key in s.references
    )
    not_null = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'not_null_{c}' AS constraint_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM w_{t}"
        for t, s in WAREHOUSE.items()
        for c in s.not_null
    )
    discount = (
        "SELECT 'order_items' AS table_name, 'range_item_discount_0_1' AS constraint_name, "
        "CAST(count(*) FILTER (WHERE item_discount < 0 OR item_discount > 1) AS BIGINT) AS violations "
        "FROM w_order_items"
    )
    head = _with(RAW, FLAWED, _flawed_tables())
    return {
        "check_nonempty": head + nonempty,
        "check_primary_keys": head + pks,
        "check_foreign_keys": head + fks,
        "check_not_null": head + not_null,
        "check_discount_range": head + discount,
    }


def _cast_money(cols: list[str], money: list[str], alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(f"CAST({pre}{c} AS DOUBLE) AS {c}" if c in money else f"{pre}{c}" for c in cols)


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    raw_cols = RAW_COLUMNS
    sql["raw_orders"] = _with(RAW) + f"SELECT {_cast_money(raw_cols, MONEY['raw'])} FROM raw"
    full = _with(RAW, _warehouse("raw", "w_"))
    delta = _with(RAW, _warehouse("raw_delta", "d_"))
    for t in WAREHOUSE:
        sql[f"dwh_{t}"] = full + _select(t, f"w_{t}")
        sql[f"delta_{t}"] = delta + _select(t, f"d_{t}")
        sql[f"merged_{t}"] = _merged(t)

    marts_head = _with(RAW, _warehouse("raw", "w_"), MART_CTES)
    order_cols = WAREHOUSE["orders"].columns + ["order_date", "order_year", "order_month", "order_day"]
    sql["orders_calendar"] = marts_head + f"SELECT {_cast_money(order_cols, MONEY['orders'])} FROM orders_calendar"
    enriched_cols = WAREHOUSE["order_items"].columns + [
        "item_paid_quantity", "gross_amount", "discount_amount", "turnover_amount", "canceled_amount",
        "revenue_amount",
    ]
    sql["items_enriched"] = marts_head + f"SELECT {_cast_money(enriched_cols, ENRICHED_MONEY)} FROM items_enriched"
    agg_cols = ["order_id", "total_items_count", "canceled_items_count", "paid_items_count", *AGG_MONEY]
    sql["items_agg"] = marts_head + f"SELECT {_cast_money(agg_cols, AGG_MONEY)} FROM items_agg"
    sql["assignment_agg"] = marts_head + "SELECT * FROM assignment_agg"
    sql["first_driver"] = marts_head + "SELECT * FROM first_driver"
    sql["mart_orders"] = marts_head + MART_ORDERS
    sql["mart_products"] = marts_head + MART_PRODUCTS
    merged_head = _with(*_MERGE_HEAD, *(f"w_{t} AS ({_merged_rows(t, [])})" for t in WAREHOUSE), MART_CTES)
    sql["maintained_mart_orders"] = merged_head + MART_ORDERS
    sql["maintained_mart_products"] = merged_head + MART_PRODUCTS
    sql.update(_checks())
    return sql
