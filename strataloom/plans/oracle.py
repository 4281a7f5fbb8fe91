"""The registered queries as SQL for DuckDB, on the same tables."""

from __future__ import annotations

from strataloom.plans.workload import EVENTS_CUT, LOADED_AT, ORDERS_CUT


def _digest(*cols: str) -> str:
    fields = [f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in cols]
    return f"md5({' || '.join(fields)})"


def _money(c: str) -> str:
    return f"{c}::DECIMAL(18,2)"


def _money_sum(c: str) -> str:
    return f"sum({_money(c)})::VARCHAR"


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
PART_ATTRS = "p_name, p_brand, p_type, p_size, p_retailprice"

GEOGRAPHY = (
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)

WIDE = f"""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, c_custkey, c_name, c_acctbal,
       c_mktsegment, n_nationkey, n_name, r_name
FROM orders JOIN ({GEOGRAPHY}) ON o_custkey = c_custkey
"""

SATELLITE = f"""
SELECT {_digest('user_id')} AS user_hk, ts, event_id, event_type, {_digest('event_type')} AS hashdiff
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR prev <> event_type
"""

PAYOUT = f"""
SELECT courier_id, month, deliveries, gross::VARCHAR AS gross, avg_rating, rate::VARCHAR AS rate,
       round(gross * rate, 2)::DECIMAL(28,2)::VARCHAR AS payout
FROM (SELECT *, CASE WHEN avg_rating < 20 THEN 0.05::DECIMAL(4,2) WHEN avg_rating < 30
             THEN 0.07::DECIMAL(4,2) ELSE 0.09::DECIMAL(4,2) END AS rate
      FROM (SELECT l_suppkey AS courier_id, strftime(l_shipdate, '%Y-%m') AS month,
                   count(*) AS deliveries, sum({_money('l_extendedprice')}) AS gross,
                   sum(l_quantity::DECIMAL(18,6))::DOUBLE / count(*) AS avg_rating
            FROM lineitem GROUP BY ALL))
"""

CONVERSION = """
SELECT c_nationkey::BIGINT AS community, count(*) AS members,
       count(*) FILTER (WHERE hit) AS converted,
       count(*) FILTER (WHERE hit) / count(*) AS ratio
FROM (SELECT j.user_id, EXISTS (SELECT 1 FROM events m WHERE m.user_id = j.user_id
             AND m.event_type = 'purchase' AND m.ts >= j.joined_at
             AND m.ts <= j.joined_at + INTERVAL 1 DAY) AS hit
      FROM (SELECT user_id, min(ts) AS joined_at FROM events WHERE event_type = 'signup'
            GROUP BY user_id) j)
JOIN customer ON user_id = c_custkey GROUP BY ALL
"""

TURNOVER = f"""
SELECT o_orderdate::DATE::VARCHAR AS day, o_orderstatus AS status, {_money_sum('o_totalprice')} AS amount,
       count(*) AS operations, count(DISTINCT o_custkey) AS accounts,
       count(*) / count(DISTINCT o_custkey) AS operations_per_account
FROM orders GROUP BY ALL
"""

SPEND = f"SELECT o_custkey, sum({_money('o_totalprice')}) AS total FROM orders GROUP BY o_custkey"

KNOWN = "(SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"


def _check(check: str, table: str, column: str, failed: str, total: str, source: str) -> str:
    return f"""
SELECT '{check}' AS "check", '{table}' AS table_name, '{column}' AS column_name,
       ({failed})::BIGINT AS failed, ({total})::BIGINT AS total, ({failed}) = 0 AS passed
FROM {source}"""


def _checks(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_OPEN = "customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey"
_KEYS = "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"
_ORDER_KEYS = "(SELECT count(*) AS n FROM orders GROUP BY o_orderkey)"
_HASH_LOAD = f"CASE WHEN first_at < TIMESTAMP '{ORDERS_CUT}' THEN TIMESTAMP '{LOADED_AT[0]}' ELSE TIMESTAMP '{LOADED_AT[1]}' END"

QUARANTINE = """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderkey, o_custkey, o_orderdate,
               c_custkey, c_acctbal,
               nullif(concat_ws(';', CASE WHEN c_acctbal < 0 THEN 'range:c_acctbal' END,
                      CASE WHEN l_shipdate < o_orderdate THEN 'order:o_orderdate,l_shipdate' END), '') AS reason
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

CUSTOMERS = ", count(DISTINCT o_custkey) AS customers"


def _totals(keys: str, sets: str, more: str = "") -> str:
    return f"""
        SELECT {keys}, grouping({keys})::BIGINT AS grouping_id, count(*) AS orders, {_money_sum('o_totalprice')} AS revenue{more}
        FROM (SELECT *, r_name AS region, n_name AS nation, o_orderdate::DATE::VARCHAR AS day
              FROM orders JOIN ({GEOGRAPHY}) ON o_custkey = c_custkey)
        GROUP BY {sets}"""


SQL: dict[str, str] = {
    "lake_read": "SELECT * FROM orders",
    "landed_pages_flatten": "SELECT * FROM orders WHERE (o_orderkey // 100) % 7 NOT IN (3, 5)",
    "landed_pages_rejected": "SELECT DISTINCT o_orderkey // 100 AS page FROM orders WHERE (o_orderkey // 100) % 7 = 3",
    "documents_flatten": """
        WITH docs AS (SELECT *, turn % 7 = 6 AS broken FROM conversations)
        SELECT conv_id, turn, role, role || '!' AS title, (pos - 1)::INTEGER AS pos, line, NULL::VARCHAR AS rejected
        FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos
              FROM docs WHERE NOT broken AND role <> 'system')
        UNION ALL SELECT conv_id, turn, role, role || '!', NULL, NULL, NULL FROM docs WHERE NOT broken AND role = 'system'
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{' FROM docs WHERE broken""",
    "json_props": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract(props, '$.k')::BIGINT END AS k,
               CASE WHEN event_type = 'error' THEN 'oops' END AS rejected FROM events""",
    "cold_to_columnar": "SELECT *, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem",
    "kafka_encode": """
        SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS key,
               '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id
               || ',"event_type":"' || event_type || '","value":' || round(value * 100)::BIGINT
               || coalesce(',"props":' || to_json(props)::VARCHAR, '') || '}' AS value
        FROM events""",
    "kafka_round_trip": "SELECT * FROM events",
    "staging_load": f"""
        SELECT {', '.join(f'{c}::VARCHAR AS {c}' for c in ORDERS)}, 'orders' AS source,
               TIMESTAMP '{LOADED_AT[0]}' AS load_ts, {_digest(*ORDERS)} AS row_hash
        FROM orders""",
    "core_typed": f"""
        SELECT o_orderkey, o_custkey, nullif(trim(o_orderstatus), '') AS o_orderstatus,
               {_money('o_totalprice')}::VARCHAR AS o_totalprice, o_orderdate,
               coalesce(nullif(trim(o_orderpriority), ''), '5-LOW') AS o_orderpriority
        FROM orders""",
    "dim_build": f"""
        SELECT {_digest('p_partkey')} AS part_sk, p_partkey, {PART_ATTRS}
        FROM (SELECT part.*, row_number() OVER (PARTITION BY p_partkey
                     ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
              FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE rn = 1
        UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, NULL""",
    "fact_build": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate,
               CASE WHEN p_partkey IS NULL THEN '-1' ELSE {_digest('p_partkey')} END AS part_sk, p_partkey, p_brand
        FROM lineitem LEFT JOIN (SELECT p_partkey, p_brand FROM part WHERE p_size <= 25) ON l_partkey = p_partkey""",
    "model_split": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
               {_digest('c_custkey')} AS customer_sk, {_digest('n_nationkey')} AS nation_sk
        FROM ({WIDE})""",
    "model_split_sizes": f"""
        SELECT 'customer' AS table_name, count(DISTINCT c_custkey) + 1 AS n_rows FROM ({WIDE})
        UNION ALL SELECT 'nation', count(DISTINCT n_nationkey) + 1 FROM ({WIDE})
        UNION ALL SELECT 'fact', count(*) FROM ({WIDE})""",
    "compat_view": WIDE,
    "vault_hub": f"""
        SELECT {_digest('o_custkey')} AS customer_hk, o_custkey, {_HASH_LOAD} AS load_ts, 'orders' AS source
        FROM (SELECT o_custkey, min(o_orderdate) AS first_at FROM orders GROUP BY o_custkey)""",
    "vault_link": f"""
        SELECT {_digest('o_orderkey', 'o_custkey')} AS order_customer_hk, {_digest('o_orderkey')} AS order_hk,
               {_digest('o_custkey')} AS customer_hk, {_HASH_LOAD} AS load_ts, 'orders' AS source
        FROM (SELECT o_orderkey, o_custkey, min(o_orderdate) AS first_at FROM orders GROUP BY ALL)""",
    "vault_satellite": SATELLITE,
    "vault_satellite_stored": SATELLITE,
    "vault_current": f"""
        SELECT user_hk, ts, event_id, event_type, hashdiff FROM
        (SELECT *, row_number() OVER (PARTITION BY user_hk ORDER BY ts DESC, event_id DESC) AS rn
         FROM ({SATELLITE})) WHERE rn = 1""",
    "dedup_exact": """
        SELECT * EXCLUDE (rn) FROM
        (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
        WHERE rn = 1""",
    "dedup_latest": """
        SELECT * EXCLUDE (rn) FROM
        (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
                l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem)
        WHERE rn = 1""",
    "filter_status": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "active_window": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'",
    "join_inner": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, o_orderkey, o_custkey,
               o_orderdate, p_partkey, p_name, p_brand
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "join_left_unknown": f"""
        SELECT o_orderkey, o_custkey, o_totalprice,
               CASE WHEN c_custkey IS NULL THEN '-1' ELSE {_digest('c_custkey')} END AS customer_sk
        FROM orders LEFT JOIN {KNOWN} ON o_custkey = c_custkey""",
    "join_broadcast_lookup": f"SELECT * FROM {GEOGRAPHY}",
    "join_semi": """
        SELECT * FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""",
    "join_anti": f"SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM {KNOWN})",
    "agg_group": f"""
        SELECT o_custkey, count(*) AS n_orders, {_money_sum('o_totalprice')} AS total,
               sum({_money('o_totalprice')})::DOUBLE / count(*) AS average,
               min(o_totalprice) AS smallest, max(o_totalprice) AS largest,
               min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
        FROM orders GROUP BY o_custkey""",
    "agg_distinct": "SELECT ts::DATE::VARCHAR AS day, count(DISTINCT user_id) AS n_user_id FROM events GROUP BY ALL",
    "agg_conditional": """
        SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS hits,
               count(*) FILTER (WHERE event_type IN ('purchase', 'view')) AS base,
               hits / nullif(base, 0) AS ratio
        FROM events GROUP BY user_id""",
    "token_count": """
        SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents)
        WHERE token <> '' GROUP BY token""",
    "ntile_global": f"""
        SELECT o_custkey, total::VARCHAR AS total, ntile(5) OVER (ORDER BY total, o_custkey)::INTEGER AS bucket
        FROM ({SPEND})""",
    "lag_change": """
        SELECT * EXCLUDE (prev) FROM
        (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
        WHERE prev IS NULL OR prev <> event_type""",
    "running_total": f"""
        SELECT courier_id, month, payout, sum(payout::DECIMAL(18,2)) OVER (PARTITION BY courier_id
               ORDER BY month ROWS UNBOUNDED PRECEDING)::VARCHAR AS paid_so_far
        FROM ({PAYOUT})""",
    **dict.fromkeys(("stream_windows", "window_totals"), f"""
        SELECT begins AS window_start, begins + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n,
               sum({_money('value')})::VARCHAR AS total
        FROM (SELECT *, unnest(range(time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 18 HOUR, ts + INTERVAL 1 MICROSECOND,
                                     INTERVAL 6 HOUR)) AS begins FROM events)
        WHERE begins <= ts AND ts < begins + INTERVAL 1 DAY GROUP BY begins, event_type"""),
    **dict.fromkeys(("stream_sessions", "session_totals"), f"""
        WITH marked AS (SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 6 HOUR, true) AS new FROM events
                        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
             numbered AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                           ROWS UNBOUNDED PRECEDING) AS session FROM marked)
        SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, user_id, count(*) AS n,
               sum({_money('value')})::VARCHAR AS total
        FROM numbered GROUP BY user_id, session"""),
    "stream_interval_join": """
        SELECT s.event_id, s.user_id, s.ts, p.event_id AS message_id, p.ts AS sent_at
        FROM (SELECT * FROM events WHERE event_type = 'signup') s LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
          ON s.user_id = p.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 1 DAY""",
    "asof_join": """
        SELECT p.event_id, p.user_id, p.ts, p.value,
               CASE WHEN p.ts < v.ts + INTERVAL 1 DAY THEN v.event_id END AS action_id,
               CASE WHEN p.ts < v.ts + INTERVAL 1 DAY THEN v.event_type END AS action
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
    "interval_join": """
        WITH offers AS (SELECT p_partkey, days, TIMESTAMP '1995-06-01' + to_days(p_size * 20) AS opens_at,
                               TIMESTAMP '1995-06-01' + to_days(p_size * 20 + days) AS ends_at
                        FROM part, (VALUES (1), (30), (1500)) o(days))
        SELECT l_partkey AS part, l_orderkey, l_linenumber, l_suppkey, l_shipdate AS sent_at,
               l_shipdate + to_days(l_quantity::INTEGER) AS due_at, days, opens_at, ends_at
        FROM lineitem JOIN offers ON l_partkey = p_partkey
         AND greatest(l_shipdate, opens_at) < least(l_shipdate + to_days(l_quantity::INTEGER), ends_at)""",
    "range_frame": f"""
        SELECT o_orderkey, o_custkey, o_orderdate, price::VARCHAR AS price, count(*) OVER w AS n_90_days,
               (sum(price) OVER w)::VARCHAR AS spent_90_days, (max(price) OVER w)::VARCHAR AS most_90_days
        FROM (SELECT *, {_money('o_totalprice')} AS price FROM orders)
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)""",
    "top_k": f"""
        SELECT s.o_custkey, s.total::VARCHAR AS total FROM ({SPEND}) s
        ORDER BY s.total DESC, s.o_custkey LIMIT 25""",
    "union_sources": "SELECT * FROM orders",
    "except_recon": f"""
        WITH staged AS (SELECT o_orderkey, o_orderstatus, {_money('o_totalprice')} AS price FROM orders),
             core AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P'
                             THEN round(o_totalprice, 0) ELSE o_totalprice END::DECIMAL(18,2) AS price
                      FROM orders WHERE o_orderpriority <> '1-URGENT')
        SELECT o_orderkey, o_orderstatus, price::VARCHAR AS price, side, count(*) AS copies FROM (
            SELECT *, 'left' AS side FROM (SELECT * FROM staged EXCEPT ALL SELECT * FROM core)
            UNION ALL
            SELECT *, 'right' AS side FROM (SELECT * FROM core EXCEPT ALL SELECT * FROM staged))
        GROUP BY ALL""",
    "stream_read": "SELECT * FROM events",
    "stream_dedup": "SELECT * FROM events",
    "stream_static_join": f"""
        SELECT user_id, event_id, ts, event_type, value, props, c_name, c_mktsegment
        FROM events LEFT JOIN {KNOWN} ON user_id = c_custkey""",
    "stream_fanout": "SELECT *, 'a' AS target FROM events UNION ALL SELECT *, 'b' FROM events",
    "stream_layers": f"""
        SELECT user_id, count(*) AS events, {_money_sum('value')} AS value, max(ts) AS last_seen
        FROM events GROUP BY user_id""",
    "stream_late": f"""
        SELECT event_type, count(*) AS kept,
               (SELECT count(*) FROM events WHERE ts < TIMESTAMP '{EVENTS_CUT}') AS late_in_all
        FROM events WHERE ts >= TIMESTAMP '{EVENTS_CUT}' GROUP BY event_type""",
    "rfm": f"""
        WITH base AS (
            SELECT c_custkey AS user_id, max(o_orderdate) AS last_order, count(o_orderkey) AS n_orders,
                   coalesce(sum({_money('o_totalprice')}), 0) AS total
            FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey
            GROUP BY c_custkey)
        SELECT user_id, last_order, n_orders, total::VARCHAR AS total,
               ntile(5) OVER (ORDER BY last_order NULLS FIRST, user_id)::INTEGER AS recency,
               ntile(5) OVER (ORDER BY n_orders, user_id)::INTEGER AS frequency,
               ntile(5) OVER (ORDER BY base.total, user_id)::INTEGER AS monetary
        FROM base""",
    "courier_payout": PAYOUT,
    "first_message_conversion": f"SELECT * FROM ({CONVERSION}) ORDER BY ratio DESC, community LIMIT 10",
    "first_message_conversion_all": CONVERSION,
    "social_activity": """
        SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS n_actions,
               count(*) FILTER (WHERE event_type = 'click') AS n_click,
               count(*) FILTER (WHERE event_type = 'error') AS n_error,
               count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
               count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
               count(*) FILTER (WHERE event_type = 'view') AS n_view,
               min(ts) AS first_action, max(ts) AS last_action
        FROM events GROUP BY ALL""",
    "customer_category": """
        SELECT o_custkey AS customer_id, p_brand AS brand, count(DISTINCT o_orderkey) AS orders,
               count(*) AS items
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL""",
    "dashboard_kpi": f"""
        SELECT day, region, orders, (cents::DECIMAL(28,0) * 0.01::DECIMAL(3,2))::DECIMAL(28,2)::VARCHAR AS revenue, customers,
               (((2 * cents + orders) // (2 * orders))::DECIMAL(28,0) * 0.01::DECIMAL(3,2))::DECIMAL(28,2)::VARCHAR AS avg_check
        FROM (SELECT o_orderdate::DATE::VARCHAR AS day, r_name AS region, count(*) AS orders,
                     (sum({_money('o_totalprice')}) * 100)::BIGINT AS cents,
                     count(DISTINCT o_custkey) AS customers
              FROM orders JOIN ({GEOGRAPHY}) ON o_custkey = c_custkey GROUP BY ALL)""",
    "daily_turnover": TURNOVER,
    "ranks_global": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate,
               rank() OVER up AS rank, dense_rank() OVER up AS dense_rank, percent_rank() OVER up AS percent_rank,
               rank() OVER down AS newest_rank, dense_rank() OVER down AS newest_dense,
               percent_rank() OVER down AS newest_percent
        FROM lineitem
        WINDOW up AS (ORDER BY l_quantity NULLS FIRST, l_shipdate NULLS FIRST),
               down AS (ORDER BY l_shipdate DESC NULLS LAST)""",
    "kpi_rollup": _totals("region, nation, day", "ROLLUP (region, nation, day)", CUSTOMERS),
    "kpi_cube": _totals("region, o_orderstatus, day", "CUBE (region, o_orderstatus, day)", CUSTOMERS),
    "kpi_grouping_sets": _totals("day, region", "GROUPING SETS ((day), (region))"),
    "pivot_status": f"""
        SELECT o_orderdate::DATE::VARCHAR AS day, {', '.join(
            f"nullif(count(*) FILTER ({w}), 0) AS {s}_orders, (sum({_money('o_totalprice')}) FILTER ({w}))::VARCHAR AS {s}_revenue"
            for s in 'FOP' for w in [f"WHERE o_orderstatus = '{s}'"])}
        FROM orders GROUP BY ALL""",
    "pivot_segments": f"""
        SELECT c_nationkey, {', '.join(
            f'nullif(count(*) FILTER ({w}), 0) AS "{s}_customers", max(c_acctbal) FILTER ({w}) AS "{s}_best"'
            for s, w in [("BUILDING", "WHERE c_mktsegment = 'BUILDING'"), ("MACHINERY", "WHERE c_mktsegment = 'MACHINERY'"),
                         ("rest", "WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")])}
        FROM customer GROUP BY ALL""",
    "sketch_trailing": """
        WITH months AS (SELECT (year(o_orderdate) * 12 + month(o_orderdate))::INTEGER AS month, o_custkey FROM orders)
        SELECT a.month, count(DISTINCT b.o_custkey) AS accounts, true AS within_error
        FROM (SELECT DISTINCT month FROM months) a JOIN months b ON b.month BETWEEN a.month - 2 AND a.month
        GROUP BY a.month""",
    "increment_read": f"SELECT * FROM events WHERE ts > TIMESTAMP '{EVENTS_CUT}'",
    "period_rebuild": """
        SELECT * REPLACE (CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice ELSE 0.0 END::DOUBLE
                          AS o_totalprice), strftime(o_orderdate, '%Y-%m') AS month
        FROM orders""",
    "mart_refresh": f"""
        SELECT day::DATE::VARCHAR AS day, o_orderstatus AS status, {_money_sum('o_totalprice')} AS amount,
               count(*) AS operations, count(DISTINCT o_custkey) AS accounts,
               count(*) / count(DISTINCT o_custkey) AS operations_per_account
        FROM (SELECT *, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate END AS day FROM orders
              WHERE o_totalprice >= 50000)
        GROUP BY day::DATE, o_orderstatus""",
    "upsert": """
        SELECT * REPLACE (CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END::DOUBLE AS c_acctbal),
               CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS version FROM customer
        UNION ALL
        SELECT * REPLACE (-c_custkey - 1 AS c_custkey), 1 FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    "load_journal": """
        SELECT 'orders' AS source, year(o_orderdate)::BIGINT AS load, count(*) AS rows,
               min(o_orderdate) AS lowest, max(o_orderdate) AS highest
        FROM orders GROUP BY ALL""",
    "dq_not_null": _checks(*[
        _check("not_null", "customer_orders", c, f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)", _OPEN)
        for c in ("c_custkey", "c_name", "o_orderkey", "o_totalprice")
    ]),
    "dq_unique": _checks(
        _check("unique", "lineitem", "l_orderkey,l_linenumber", "sum(n - 1)", "sum(n)", _KEYS),
        _check("unique", "orders", "o_orderkey", "sum(n - 1)", "sum(n)", _ORDER_KEYS),
    ),
    "dq_accepted": _check(
        "accepted", "events", "event_type",
        "count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view'))", "count(*)", "events",
    ),
    "dq_range": _checks(
        _check("range", "customer", "c_acctbal", "count(*) FILTER (WHERE c_acctbal < 0)", "count(*)", "customer"),
        _check("range", "customer", "c_nationkey", "count(*) FILTER (WHERE c_nationkey NOT BETWEEN 0 AND 24)",
               "count(*)", "customer"),
    ),
    "dq_reference": _checks(
        _check("reference", "orders", "o_custkey", "count(*) FILTER (WHERE c_custkey IS NULL)", "count(*)",
               f"orders LEFT JOIN {KNOWN} ON o_custkey = c_custkey"),
        _check("reference", "orders", "o_custkey", "count(*) FILTER (WHERE c_custkey IS NULL)", "count(*)",
               "orders LEFT JOIN customer ON o_custkey = c_custkey"),
    ),
    "dq_reconcile": f"""
        WITH text AS (SELECT o_custkey::VARCHAR AS o_custkey, o_totalprice::VARCHAR AS o_totalprice FROM orders),
             staged AS (SELECT count(*) AS n, sum(o_totalprice::DECIMAL(18,2)) AS price,
                               sum(o_custkey::DECIMAL(20,0)) AS cust FROM text),
             core AS (
                SELECT 'orders' AS t, count(*) AS n, sum({_money('o_totalprice')}) AS price,
                       sum(o_custkey::DECIMAL(20,0)) AS cust FROM orders
                UNION ALL
                SELECT 'orders_broken', count(*), sum({_money('o_totalprice')}) FILTER (WHERE o_totalprice >= 5000),
                       sum(o_custkey::DECIMAL(20,0)) FROM orders),
             diffs AS (
                SELECT t, unnest(['*', 'o_totalprice', 'o_custkey']) AS c,
                       unnest([core.n <> staged.n, core.price <> staged.price, core.cust <> staged.cust]) AS bad
                FROM core, staged)
        SELECT 'reconcile' AS "check", t AS table_name, c AS column_name, bad::BIGINT AS failed,
               1::BIGINT AS total, NOT bad AS passed
        FROM diffs""",
    "dq_order": _check(
        "order", "lineitem_orders", "o_orderdate,l_shipdate",
        "count(*) FILTER (WHERE l_shipdate < o_orderdate)", "count(*)",
        "lineitem JOIN orders ON l_orderkey = o_orderkey",
    ),
    "dq_quarantine": QUARANTINE,
    "dq_quarantine_split": f"SELECT *, CASE WHEN reason IS NULL THEN 'good' ELSE 'rejected' END AS part FROM ({QUARANTINE})",
}
