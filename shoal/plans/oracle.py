"""Independent SQL (DuckDB dialect) for each registered query.

The SQL restates the input rules of ``sources.testdata`` directly on the
generated tables and computes each result with plain window functions and
joins, without the library's operators.
"""

from __future__ import annotations

# Page log of the events table (rules in sources.testdata).
_PAGE_LOG = """
  SELECT event_id AS seq,
         'mid_' || CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 2 = 0 THEN '1' ELSE '0' END
           AS is_new,
         event_type AS page_id,
         CASE WHEN event_type IN ('view', 'signup') THEN NULL
              WHEN event_type = 'click' THEN '' ELSE 'home' END AS last_page_id,
         {ts} AS ts
  FROM events
"""
_REAL_MS = "epoch_us(ts) // 1000"
_JUMP_MS = "1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 4000"

PAGE_LOG = _PAGE_LOG.format(ts=_REAL_MS)
JUMP_LOG = _PAGE_LOG.format(ts=_JUMP_MS)

_DAY = "strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d')"
_SECOND = "strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"


def _fmt(gran: str, ms: str) -> str:
    return (_DAY if gran == "day" else _SECOND).format(ms=ms)


def _user_jump(log: str) -> str:
    return f"""
WITH pl AS ({log}),
e AS (
  SELECT *, coalesce(last_page_id, '') = '' AS is_entry FROM pl
),
n AS (
  SELECT *, lead(ts) OVER w AS next_ts, lead(is_entry) OVER w AS next_entry
  FROM e WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
)
SELECT seq, mid, is_new, page_id, last_page_id, ts,
       CASE WHEN next_ts IS NOT NULL AND next_ts - ts < 10000 AND next_entry THEN 'match'
            ELSE 'timeout' END AS reason
FROM n
WHERE is_entry
  AND (next_ts IS NULL OR next_ts - ts >= 10000 OR next_entry)
"""


def _unique_visitor(gran: str) -> str:
    return f"""
WITH pl AS ({PAGE_LOG}),
e AS (
  SELECT *, {_fmt(gran, 'ts')} AS vd FROM pl WHERE coalesce(last_page_id, '') = ''
),
n AS (SELECT *, lag(vd) OVER (PARTITION BY mid ORDER BY seq) AS prev_vd FROM e)
SELECT seq, mid, is_new, page_id, last_page_id, ts
FROM n WHERE prev_vd IS NULL OR prev_vd <> vd
"""


def _fix_is_new(gran: str, src: str = PAGE_LOG) -> str:
    return f"""
WITH pl AS ({src}),
f AS (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN {_fmt(gran, 'ts')}
                             ELSE {_fmt(gran, 'ts - 86400000')} END)
              OVER (PARTITION BY mid ORDER BY seq) AS first_visit
  FROM pl
)
SELECT seq, mid,
       CASE WHEN is_new = '1' AND first_visit <> {_fmt(gran, 'ts')} THEN '0' ELSE is_new END
         AS is_new,
       page_id, last_page_id, ts
FROM f
"""


# Clean log records with the repaired flag (day granularity). Dirty rows are
# the events with event_id % 97 = 0; they take no part in the repair.
_CLEAN_LOG = f"""
WITH ev AS (
  SELECT event_id AS seq, event_type,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         'mid_' || CAST(user_id AS VARCHAR) AS mid, 'b' || CAST(user_id % 7 AS VARCHAR) AS ba,
         {_REAL_MS} AS ts
  FROM events WHERE event_id % 97 <> 0
),
pl AS (
  SELECT *, CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS flag FROM ev
),
f AS (
  SELECT *, first_value(CASE WHEN flag = '1' THEN {_fmt('day', 'ts')}
                             ELSE {_fmt('day', 'ts - 86400000')} END)
              OVER (PARTITION BY mid ORDER BY seq) AS first_visit
  FROM pl
)
SELECT seq, event_type, k, mid, ba, ts,
       CASE WHEN flag = '1' AND first_visit <> {_fmt('day', 'ts')} THEN '0' ELSE flag END
         AS is_new,
       CASE WHEN event_type IN ('view', 'signup') THEN NULL
            WHEN event_type = 'click' THEN '' ELSE 'home' END AS last_page_id
FROM f
"""

LOG_DIRTY = """
SELECT event_id AS seq,
       CASE (event_id // 97) % 6 WHEN 0 THEN '{bad' WHEN 1 THEN '[1]' WHEN 2 THEN '"x"' WHEN 3 THEN ''
            WHEN 4 THEN '{"a":1}' ELSE '{"common":{"mid":"mid_1","is_new":"1"}}' END AS value
FROM events WHERE event_id % 97 = 0
"""
_EXTRA = "k AS extra_k, event_type AS extra_tag"

LOG_ERROR = f"""
WITH c AS ({_CLEAN_LOG})
SELECT seq, mid, is_new, ba, event_type AS page_id,
       CASE WHEN k % 5 = 0 THEN 'E' ELSE '' END || CAST(k AS VARCHAR) AS error_code,
       'error ' || CAST(k AS VARCHAR) AS msg, ts, {_EXTRA}
FROM c WHERE event_type = 'error'
"""

LOG_START = f"""
WITH c AS ({_CLEAN_LOG})
SELECT seq, mid, is_new, ba, 'icon' AS entry, k AS loading_time, ts, {_EXTRA}
FROM c WHERE event_type = 'signup'
"""

LOG_DISPLAY = f"""
WITH c AS ({_CLEAN_LOG}),
x AS (
  SELECT seq, mid, is_new, ba, event_type AS page_id, ts, unnest(range(1, k % 4 + 1)) AS i
  FROM c WHERE event_type = 'view' AND k % 4 > 0
)
SELECT seq, mid, is_new, ba, page_id, ts, 'sku_' || CAST(i AS VARCHAR) AS item,
       'sku_id' AS item_type, i AS display_order, i * 10 AS pos_id
FROM x
"""

LOG_ACTION = f"""
WITH c AS ({_CLEAN_LOG}),
x AS (
  SELECT seq, mid, is_new, ba, event_type AS page_id, ts, unnest(range(1, k % 3 + 1)) AS i
  FROM c WHERE event_type = 'click' AND k % 3 > 0
)
SELECT seq, mid, is_new, ba, page_id, 'act_' || CAST(i AS VARCHAR) AS action_id,
       'sku_' || CAST(i AS VARCHAR) AS item, ts + i AS action_ts, i AS action_extra
FROM x
"""

LOG_PAGE = f"""
WITH c AS ({_CLEAN_LOG})
SELECT seq, mid, is_new, ba, event_type AS page_id, last_page_id, k * 100 AS during_time,
       'item_' || CAST(k AS VARCHAR) AS page_item, ts, {_EXTRA}
FROM c WHERE event_type <> 'signup'
"""


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(16,2)) AS VARCHAR)"


_DETAIL_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
              "strftime(l_shipdate, '%Y-%m-%d'), " + _money("l_extendedprice") + ")")
_EPOCH_S = "CAST(CAST(epoch({c}) AS BIGINT) + {shift} AS VARCHAR)"

CHANGE_ENVELOPE = """
SELECT (8796093022208 + c_custkey) AS seq, 'customer' AS "table", 'insert' AS type,
       '1700000000' AS ts, CAST(5 AS BIGINT) AS n_fields FROM customer
UNION ALL
SELECT (9895604649984 + s_suppkey), 'supplier', 'insert', '1700000000', 4 FROM supplier
UNION ALL
SELECT (10995116277760 + p_partkey), 'part', 'insert', '1700000000', 6 FROM part
UNION ALL
SELECT (1099511627776 + c_custkey), 'customer', 'update', '1700000100', 2
FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT (2199023255552 + s_suppkey), 'supplier', 'delete', '1700000200', 4
FROM supplier WHERE s_acctbal < 0
UNION ALL
SELECT (15393162788864 + o_orderkey), 'orders', 'insert', '1700000000', 2 FROM orders
"""

CART_ADD = f"""
WITH c AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, l_suppkey, l_partkey, l_linestatus,
         l_shipdate, CAST(l_quantity AS BIGINT) AS qty,
         lag(CAST(l_quantity AS BIGINT)) OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS prev_qty
  FROM lineitem
)
SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(l_suppkey AS VARCHAR) AS source_id, l_linestatus AS source_type,
       'open line' AS source_type_name,
       CAST(CASE WHEN prev_qty IS NULL THEN qty ELSE qty - prev_qty END AS VARCHAR) AS sku_num,
       {_EPOCH_S.format(c='l_shipdate', shift=0)} AS ts
FROM c
WHERE l_linestatus = 'O' AND (prev_qty IS NULL OR qty > prev_qty)
"""

_ORDER_ROWS = f"""
  SELECT o_orderkey, 'insert' AS type,
         CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS order_status,
         NULL AS old_order_status, o_orderdate AS op_time, 0 AS shift, o_custkey, o_orderdate
  FROM orders
  UNION ALL
  SELECT o_orderkey, 'update', 'P', 'O', o_orderdate + INTERVAL 1 DAY, 86400, o_custkey,
         o_orderdate
  FROM orders WHERE o_orderstatus = 'P'
"""

_WIDE = f"""
WITH od AS (
  SELECT {_DETAIL_ID} AS id, * FROM lineitem WHERE l_linestatus = 'O'
),
oi AS (
  SELECT r.*, c.c_nationkey FROM ({_ORDER_ROWS}) r
  LEFT JOIN customer c ON c.c_custkey = r.o_custkey
),
act AS (
  SELECT {_DETAIL_ID} AS id, CAST(l_suppkey AS VARCHAR) AS activity_id,
         {_money('l_discount')} AS activity_rule_id
  FROM lineitem WHERE l_discount > 0.05
),
cou AS (
  SELECT {_DETAIL_ID} AS id, CAST(l_partkey AS VARCHAR) AS coupon_id
  FROM lineitem WHERE l_returnflag = 'R'
),
w AS (
SELECT od.id, CAST(od.l_orderkey AS VARCHAR) AS order_id, CAST(od.l_partkey AS VARCHAR) AS sku_id,
       'sku_' || CAST(od.l_partkey AS VARCHAR) AS sku_name,
       strftime(od.l_shipdate, '%Y-%m-%d') AS date_id,
       strftime(od.l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       CAST(od.l_suppkey AS VARCHAR) AS source_id, od.l_linestatus AS source_type,
       CAST(CAST(od.l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
       CAST(CAST(CAST(od.l_quantity AS BIGINT) AS DECIMAL(16,2))
            * CAST(od.l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
       {_money('od.l_discount')} AS split_activity_amount,
       {_money('od.l_tax')} AS split_coupon_amount,
       {_money('od.l_extendedprice')} AS split_total_amount,
       {_EPOCH_S.format(c='od.l_shipdate', shift=0)} AS od_ts,
       CAST(oi.o_custkey AS VARCHAR) AS user_id, CAST(oi.c_nationkey AS VARCHAR) AS province_id,
       strftime(oi.op_time, '%Y-%m-%d') AS operate_date_id,
       strftime(oi.op_time, '%Y-%m-%d %H:%M:%S') AS operate_time,
       oi.order_status, oi.type,
       {_EPOCH_S.format(c='oi.o_orderdate', shift='oi.shift')} AS oi_ts,
       act.activity_id, act.activity_rule_id, cou.coupon_id,
       'open line' AS source_type_name, oi.old_order_status
FROM od
JOIN oi ON od.l_orderkey = oi.o_orderkey
LEFT JOIN act ON act.id = od.id
LEFT JOIN cou ON cou.id = od.id
)
"""

ORDER_WIDE = _WIDE + "SELECT * FROM w"
ORDER_PLACED = _WIDE + "SELECT * FROM w WHERE type = 'insert'"
ORDER_WIDE_LATEST = _WIDE + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY CAST(oi_ts AS BIGINT) DESC,
                                                   type = 'update' DESC) AS rn
  FROM w) WHERE rn = 1
"""


def _demo_join(how: str) -> str:
    return f"""
SELECT e.o_orderkey AS empno, e.o_orderpriority AS ename, e.o_custkey * 2 AS deptno,
       d.c_name AS dname
FROM orders e {how.upper()} JOIN customer d ON e.o_custkey * 2 = d.c_custkey
"""


_ARRIVING = """
WITH emp AS (SELECT o_orderkey AS empno, o_orderpriority AS ename, o_custkey * 2 AS deptno, o_orderkey * 2 AS emp_at FROM orders),
dept AS (SELECT c_custkey AS d_deptno, c_name AS dname, c_custkey * 20 + 1 AS dept_at FROM customer)
"""

JOIN_LEFT_CHANGES = _ARRIVING + """
SELECT '+I' AS op, greatest(emp_at, dept_at) AS at, 1 AS nth, empno, ename, deptno, dname FROM emp JOIN dept ON deptno = d_deptno
UNION ALL
SELECT '+I', emp_at, 1, empno, ename, deptno, NULL FROM emp LEFT JOIN dept ON deptno = d_deptno
WHERE dept_at IS NULL OR emp_at < dept_at
UNION ALL
SELECT '-D', dept_at, 0, empno, ename, deptno, NULL FROM emp JOIN dept ON deptno = d_deptno WHERE emp_at < dept_at
"""

JOIN_FULL_UPSERT = _ARRIVING + "SELECT empno, ename, deptno, d_deptno, dname FROM emp FULL JOIN dept ON deptno = d_deptno"

ORDER_WIDE_UPSERT = f"""
WITH od AS (SELECT DISTINCT {_DETAIL_ID} AS id, l_orderkey, l_partkey, l_extendedprice FROM lineitem),
oi AS (
  SELECT r.*, c.c_nationkey, CASE WHEN r.type = 'update' THEN 3 ELSE 2 END * (1::BIGINT << 40) + o_orderkey AS oi_seq
  FROM ({_ORDER_ROWS}) r LEFT JOIN customer c ON c.c_custkey = r.o_custkey
),
act AS (
  SELECT DISTINCT {_DETAIL_ID} AS id, CAST(l_suppkey AS VARCHAR) AS activity_id, {_money('l_discount')} AS activity_rule_id
  FROM lineitem WHERE l_discount > 0.05
),
w AS (
  SELECT od.id, CAST(od.l_orderkey AS VARCHAR) AS order_id, CAST(od.l_partkey AS VARCHAR) AS sku_id,
    {_money('od.l_extendedprice')} AS split_total_amount, CAST(oi.o_custkey AS VARCHAR) AS user_id,
    CAST(oi.c_nationkey AS VARCHAR) AS province_id, strftime(oi.op_time, '%Y-%m-%d %H:%M:%S') AS operate_time, oi.order_status, oi.type,
    {_EPOCH_S.format(c='oi.o_orderdate', shift='oi.shift')} AS oi_ts, oi.oi_seq, act.activity_id, act.activity_rule_id,
    row_number() OVER (PARTITION BY od.id ORDER BY oi.oi_seq DESC, act.activity_rule_id DESC) AS rn
  FROM od JOIN oi ON od.l_orderkey = oi.o_orderkey LEFT JOIN act ON act.id = od.id
)
SELECT * EXCLUDE (rn) FROM w WHERE rn = 1
"""


INTERVAL_JOIN = """
WITH ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events)
SELECT c.event_id AS click_id, c.user_id, c.ms AS click_ts, v.event_id AS view_id,
       v.ms AS view_ts
FROM ev c JOIN ev v ON c.user_id = v.user_id
 AND v.ms BETWEEN c.ms - 21600000 AND c.ms + 21600000
WHERE c.event_type = 'click' AND v.event_type = 'view'
"""

DELIMITED_JOIN = """
WITH ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events)
SELECT CAST(c.event_id AS INTEGER) AS empno, c.event_type AS ename,
       CAST(c.user_id AS INTEGER) AS deptno, c.ms AS emp_ts,
       'view_' || CAST(v.event_id AS VARCHAR) AS dname, v.ms AS dept_ts
FROM ev c JOIN ev v ON c.user_id = v.user_id
 AND v.ms BETWEEN c.ms - 21600000 AND c.ms + 21600000
WHERE c.event_type = 'click' AND v.event_type = 'view'
"""

DATE_FUNCTIONS = """
WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_id, ms,
       strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS day,
       strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS day_time,
       epoch_us(CAST(CAST(make_timestamp(ms * 1000) AS DATE) AS TIMESTAMP)) // 1000 - 28800000
         AS day_start_ms,
       epoch_us(date_trunc('second', make_timestamp(ms * 1000))) // 1000 - 28800000 AS wall_ms
FROM e
"""

# dimension rows after trimming to the configured columns (keys sorted)
_DIM_ROWS = """
  SELECT 8796093022208 + c_custkey AS seq, 'customer' AS "table", 'insert' AS type,
         'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS pk,
         'c_acctbal,c_custkey,c_name' AS kept_keys,
         CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) || '|' || CAST(c_custkey AS VARCHAR)
           || '|' || c_name AS kept_values
  FROM customer
  UNION ALL
  SELECT 1099511627776 + c_custkey, 'customer', 'update', 'dim_customer',
         CAST(c_custkey AS VARCHAR), 'c_acctbal,c_custkey', '0.00|' || CAST(c_custkey AS VARCHAR)
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 9895604649984 + s_suppkey, 'supplier', 'insert', 'dim_supplier',
         CAST(s_suppkey AS VARCHAR), 's_name,s_nationkey,s_suppkey',
         s_name || '|' || CAST(s_nationkey AS VARCHAR) || '|' || CAST(s_suppkey AS VARCHAR)
  FROM supplier
  UNION ALL
  SELECT 2199023255552 + s_suppkey, 'supplier', 'delete', 'dim_supplier',
         CAST(s_suppkey AS VARCHAR), 's_name,s_nationkey,s_suppkey',
         s_name || '|' || CAST(s_nationkey AS VARCHAR) || '|' || CAST(s_suppkey AS VARCHAR)
  FROM supplier WHERE s_acctbal < 0
  UNION ALL
  SELECT 10995116277760 + p_partkey, 'part', 'insert', 'dim_part', CAST(p_partkey AS VARCHAR),
         'p_brand,p_partkey', p_brand || '|' || CAST(p_partkey AS VARCHAR)
  FROM part
"""

DIM_ROUTE = _DIM_ROWS

DIM_UPSERT_PARTIAL = """
SELECT 'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS pk,
       'c_acctbal,c_custkey,c_name' AS kept_keys,
       CASE WHEN c_acctbal < 0 THEN '0.00' ELSE CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR) END
         || '|' || CAST(c_custkey AS VARCHAR) || '|' || c_name AS kept_values
FROM customer
UNION ALL
SELECT 'dim_supplier', CAST(s_suppkey AS VARCHAR), 's_name,s_nationkey,s_suppkey',
       s_name || '|' || CAST(s_nationkey AS VARCHAR) || '|' || CAST(s_suppkey AS VARCHAR)
FROM supplier
UNION ALL
SELECT 'dim_part', CAST(p_partkey AS VARCHAR), 'p_brand,p_partkey',
       p_brand || '|' || CAST(p_partkey AS VARCHAR)
FROM part
"""

ORACLE: dict[str, str] = {
    "delimited_join": DELIMITED_JOIN,
    "date_functions": DATE_FUNCTIONS,
    "dim_route": DIM_ROUTE,
    "dim_upsert_partial": DIM_UPSERT_PARTIAL,
    "change_envelope": CHANGE_ENVELOPE,
    "cart_add": CART_ADD,
    "order_wide": ORDER_WIDE,
    "order_wide_latest": ORDER_WIDE_LATEST,
    "order_placed": ORDER_PLACED,
    "order_wide_upsert": ORDER_WIDE_UPSERT,
    "join_left_changes": JOIN_LEFT_CHANGES,
    "join_full_upsert": JOIN_FULL_UPSERT,
    "join_inner": _demo_join("inner"),
    "join_left": _demo_join("left"),
    "join_right": _demo_join("right"),
    "join_full": _demo_join("full"),
    "interval_join": INTERVAL_JOIN,
    "log_dirty": LOG_DIRTY,
    "log_error": LOG_ERROR,
    "log_start": LOG_START,
    "log_display": LOG_DISPLAY,
    "log_action": LOG_ACTION,
    "log_page": LOG_PAGE,
    "user_jump": _user_jump(JUMP_LOG),
    "user_jump_sparse": _user_jump(PAGE_LOG),
    "unique_visitor_day": _unique_visitor("day"),
    "unique_visitor_second": _unique_visitor("second"),
    "fix_is_new_day": _fix_is_new("day"),
    "fix_is_new_second": _fix_is_new("second"),
}
