"""DuckDB SQL for the operator-level queries (formulated independently where the
Spark side uses a rewrite: range joins instead of explode, window sums instead of
aggregate + join, full outer join instead of one signed union, plain windows instead of
the range-partitioned type-2 history)."""
from __future__ import annotations

from oracle.models import COMMENT_PATTERN, COST_PER_QUERY, DAILY_RATES, model_sql

K1_HOUR_GRID = """
WITH b AS (SELECT min(date_trunc('hour', ts)) AS lo, max(date_trunc('hour', ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b)
SELECT hour, CAST(hour AS DATE) AS date, count(*) OVER (PARTITION BY CAST(hour AS DATE)) AS hours_thus_far,
       CAST(dayofmonth(last_day(CAST(hour AS DATE))) AS INTEGER) AS days_in_month
FROM h"""

_SLICES = """
WITH iv AS (SELECT event_id, user_id, ts AS s, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS e FROM events),
g AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(s)) FROM iv), (SELECT max(e) FROM iv),
                                    INTERVAL 1 HOUR)) AS hour_start),
sl AS (SELECT iv.event_id, iv.user_id, g.hour_start,
              epoch_us(least(iv.e, g.hour_start + INTERVAL 1 HOUR)) // 1000
              - epoch_us(greatest(iv.s, g.hour_start)) // 1000 AS ms
       FROM g JOIN iv ON g.hour_start >= date_trunc('hour', iv.s) AND g.hour_start < iv.e)
"""
K4_INTERVAL_SLICE = _SLICES + "SELECT event_id, hour_start, ms FROM sl"

K5_ALLOCATE = _SLICES + """,
billed AS (SELECT user_id, date_trunc('hour', ts) AS hour_start, sum(value) AS billed FROM events GROUP BY 1, 2),
w AS (SELECT *, sum(ms) OVER (PARTITION BY user_id, hour_start) AS total_ms FROM sl)
SELECT w.event_id, w.user_id, w.hour_start, w.ms,
       CASE WHEN w.total_ms = 0 THEN 0 ELSE w.ms / w.total_ms END AS fraction,
       b.billed * CASE WHEN w.total_ms = 0 THEN 0 ELSE w.ms / w.total_ms END AS allocated
FROM w JOIN billed b ON w.user_id = b.user_id AND w.hour_start = b.hour_start"""

E3_PIVOT_SUMS = """
SELECT user_id, CAST(ts AS DATE) AS day,
       sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END) AS view_value,
       sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS click_value,
       sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS purchase_value
FROM events GROUP BY 1, 2"""

K12_GAP_FILL = """
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, max(l_discount) AS rate, max(l_tax) AS tax
           FROM lineitem GROUP BY 1, 2),
b AS (SELECT min(date) AS lo, max(date) AS hi FROM d),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
                AS date FROM b),
g AS (SELECT s.l_suppkey, days.date FROM (SELECT DISTINCT l_suppkey FROM d) AS s CROSS JOIN days)
SELECT g.l_suppkey, g.date,
  coalesce(d.rate, last_value(d.rate IGNORE NULLS) OVER wb, first_value(d.rate IGNORE NULLS) OVER wa) AS rate,
  coalesce(d.tax, last_value(d.tax IGNORE NULLS) OVER wb, first_value(d.tax IGNORE NULLS) OVER wa) AS tax
FROM g LEFT JOIN d ON g.l_suppkey = d.l_suppkey AND g.date = d.date
WINDOW wb AS (PARTITION BY g.l_suppkey ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       wa AS (PARTITION BY g.l_suppkey ORDER BY g.date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""

K14_SCD2 = """
WITH o AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey,
                  lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
           FROM orders),
c AS (SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
             lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt
      FROM o WHERE o_orderpriority != coalesce(prev, ''))
SELECT o_custkey, o_orderpriority, valid_from, coalesce(nxt, (SELECT max(o_orderdate) FROM orders)) AS valid_to,
       nxt IS NULL AS is_current
FROM c"""

K15_DEDUP = f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                           l_discount, l_tax, l_returnflag, l_linestatus) = 1"""

F2_LATEST = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"""

S29_STRIP = f"""
SELECT page_id, regexp_replace(html, '{COMMENT_PATTERN}', '', 'g') AS html_no_comments,
       CAST(length(regexp_replace(html, '{COMMENT_PATTERN}', '', 'g')) AS INTEGER) AS n_chars
FROM pages"""

J1_EXPLODE = """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS query_id,
       o.o_orderdate AS query_start_time,
       CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_suppkey END AS table_id,
       'SUPPLIER_' || CAST(l.l_suppkey AS VARCHAR) AS object_name,
       CASE WHEN l.l_linestatus = 'O' THEN 'Table' ELSE 'View' END AS object_domain,
       CAST(n AS INTEGER) AS n_columns
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey, (VALUES (3), (2)) AS t(n)"""

# Per kind of record, without JSON: the two elements of each that is an array
J1_EXPLODE_RAW = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN n = 1 AND l_returnflag <> 'R' THEN l_suppkey END AS table_id,
       CASE WHEN n = 1 THEN 'SUPPLIER_' || l_suppkey END AS object_name,
       CASE WHEN n = 1 AND l_linestatus = 'O' THEN 'Table' END AS object_domain,
       CASE WHEN n = 2 THEN 0 WHEN l_discount > 0.05 THEN NULL ELSE 2 END::INTEGER AS n_columns,
       CASE WHEN n = 2 THEN 0 WHEN l_discount > 0.05 THEN NULL ELSE 1 END::INTEGER AS n_named
FROM lineitem, (VALUES (1), (2)) AS t(n) WHERE l_tax <= 0.07 AND l_tax <> 0"""

_T8 = "sign({c}) * floor(abs({c}) * 100000000.0) / 100000000.0 AS {c}"
_N1_COLS = f"l_orderkey, l_linenumber, l_partkey, {_T8.format(c='l_extendedprice')}, {_T8.format(c='l_discount')}"
N1_TABLE_DIFF = f"""
WITH a AS (SELECT {_N1_COLS} FROM lineitem),
b AS (SELECT {_N1_COLS} FROM ({K15_DEDUP}) AS d)
SELECT 'in_actual_not_in_expected' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) AS x
UNION ALL
SELECT 'in_expected_not_in_actual' AS which_diff, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) AS y"""

N2_UNMATCHED = """
WITH ko AS (SELECT DISTINCT o_orderkey AS orderkey FROM orders),
kl AS (SELECT DISTINCT l_orderkey AS orderkey FROM lineitem)
SELECT coalesce(ko.orderkey, kl.orderkey) AS orderkey,
       CASE WHEN kl.orderkey IS NULL THEN 'only_in_left' ELSE 'only_in_right' END AS side
FROM ko FULL OUTER JOIN kl ON ko.orderkey = kl.orderkey
WHERE ko.orderkey IS NULL OR kl.orderkey IS NULL"""

N3_DUPLICATES = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

N4_NULLS = model_sql("SELECT query_id, start_time, query_type FROM stg_query_history "
                     "WHERE warehouse_id IS NULL OR warehouse_size IS NULL")

S6_NEGATIVE = model_sql("SELECT query_id, hour AS hour_start, ms AS num_milliseconds_query_ran FROM part WHERE ms < 0",
                        DAILY_RATES, COST_PER_QUERY)

K9_SPREAD_DAILY = """
WITH b AS (SELECT min(date_trunc('hour', ts)) AS lo, max(date_trunc('hour', ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b),
hours AS (SELECT hour, CAST(hour AS DATE) AS date, count(*) OVER (PARTITION BY CAST(hour AS DATE)) AS n FROM h),
daily AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY 1)
SELECT hours.hour, coalesce(daily.v / hours.n, 0) AS value_per_hour
FROM hours LEFT JOIN daily ON hours.date = daily.day"""

K11_RESIDUAL = """
WITH parts AS (SELECT l_orderkey, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, o.o_totalprice - p.p AS residual
FROM orders o LEFT JOIN parts p ON o.o_orderkey = p.l_orderkey
WHERE o.o_totalprice - p.p > 0"""

K13_PRIORITY_PICK = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END DESC,
                                    l_linenumber, l_partkey, l_extendedprice) = 1"""

F5_FLAG_LATEST = """
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_latest
FROM orders"""

L7_STREAM_HOURS = _SLICES + """,
closed AS (SELECT max(hour_start) - INTERVAL 24 HOUR AS wm FROM sl)
SELECT user_id AS warehouse_id, hour_start AS hour, CAST(sum(ms) AS BIGINT) AS total_query_milliseconds_in_hour,
       count(*) AS slices
FROM sl GROUP BY 1, 2
HAVING hour_start + INTERVAL 1 HOUR <= (SELECT wm FROM closed)"""

L7_ALL_HOURS = _SLICES + """
SELECT user_id AS warehouse_id, hour_start AS hour, CAST(sum(ms) AS BIGINT) AS total_query_milliseconds_in_hour,
       count(*) AS slices
FROM sl GROUP BY 1, 2"""

# Gaps and islands over the latest end so far
_SESSIONS = """
WITH iv AS (SELECT user_id, ts AS s, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS e,
                   CAST(floor(value * 60) AS BIGINT) AS seconds, event_id FROM events WHERE user_id IS NOT NULL AND value >= 0),
o AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy FROM iv),
g AS (SELECT *, sum(CASE WHEN busy IS NULL OR s > busy + INTERVAL 300 SECOND THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY s, event_id) AS grp FROM o),
sessions AS (SELECT user_id AS warehouse_id, min(s) AS busy_from, max(e) AS busy_to, count(*) AS queries,
                    CAST(sum(seconds) AS BIGINT) AS run_seconds FROM g GROUP BY user_id, grp)
"""
L7_SESSIONS = _SESSIONS + "SELECT * FROM sessions"
L7_CLOSED_SESSIONS = _SESSIONS + """
SELECT * FROM sessions WHERE busy_to + INTERVAL 300 SECOND <= (SELECT max(s) - INTERVAL 24 HOUR FROM iv)"""

K5_STREAM = (f"SELECT * FROM ({K5_ALLOCATE}) AS a "
             "WHERE hour_start <= (SELECT max(date_trunc('hour', ts)) - INTERVAL 24 HOUR FROM events)")
