"""Independent SQL (DuckDB dialect) for every registered query.

Tables ``events orders part pages lineitem`` are the driver's parquet
files.  The CTEs below restate the adapter rules of
``tierflow.sources.testdata`` and the semantics of each job in plain SQL,
so Spark results can be compared row for row.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2025-01-01 00:00:00'"
RUN_TS2 = "TIMESTAMP '2025-01-03 00:00:00'"
REDELIVERY_TS = "TIMESTAMP '2025-01-02 00:00:00'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# events with short names: n = id, uid, et = type, t0 = time, k from props
_EV = """ev AS (
  SELECT event_id AS n, user_id AS uid, event_type AS et, ts AS t0,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

_RAW_D1 = f"""raw_d1 AS (
  SELECT
    CASE WHEN n % 1000 = 999 THEN NULL ELSE 'e' || CAST(n AS VARCHAR) END AS event_id,
    CASE WHEN n % 17 = 0 THEN NULL ELSE uid END AS user_id,
    's-' || CAST(uid AS VARCHAR) || '-' || CAST(n % 3 AS VARCHAR) AS session_id,
    CASE WHEN n % 97 = 0 THEN chr(9) || et
         WHEN n % 4 = 0 THEN '  ' || upper(et) || ' '
         WHEN n % 4 = 1 THEN upper(et)
         ELSE et END AS event_type,
    CASE WHEN n % 3 = 0 THEN ' //' || et || '///p' || CAST(uid % 7 AS VARCHAR) || ' '
         ELSE '/' || et || '/p' || CAST(uid % 7 AS VARCHAR) END AS page,
    CASE WHEN n % 5 = 0 THEN '/' || et || '?next=http://shop.example.com//p' || CAST(uid % 7 AS VARCHAR)
         ELSE '//' || et || '//' END AS route,
    CASE WHEN et = 'click' THEN '#btn-' || CAST(n % 11 AS VARCHAR) END AS element,
    CASE WHEN n % 13 = 0 THEN NULL WHEN n % 29 = 0 THEN 'not-a-time'
         ELSE strftime(t0, {ISO}) END AS ts,
    n % 19 = 0 AS m_null,
    CASE WHEN n % 19 = 0 THEN NULL WHEN n % 3 = 0 THEN 'chrome' WHEN n % 3 = 1 THEN 'firefox'
         ELSE 'safari' END AS m_browser,
    CASE WHEN n % 19 = 0 THEN NULL WHEN n % 7 = 0 THEN 'spring-' || CAST(k % 5 AS VARCHAR) END AS m_campaign,
    CAST(NULL AS VARCHAR) AS m_country,
    CASE WHEN n % 19 = 0 THEN NULL WHEN n % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS m_device,
    CASE WHEN n % 19 = 0 THEN NULL ELSE k END AS m_k,
    CASE WHEN n % 19 = 0 THEN NULL WHEN uid % 2 = 0 THEN 'linux' ELSE 'ios' END AS m_os,
    CASE WHEN n % 19 = 0 THEN NULL WHEN et = 'view' THEN 'q' || CAST(k AS VARCHAR) ELSE '' END AS m_search_term,
    t0 + INTERVAL 1 HOUR AS _ingested_at
  FROM ev)"""

_RAW_D2 = f"""raw_d2 AS (
  SELECT
    'e' || CAST(n AS VARCHAR) AS event_id,
    uid AS user_id,
    's-' || CAST(uid AS VARCHAR) || '-' || CAST(n % 3 AS VARCHAR) AS session_id,
    et AS event_type,
    '/' || et || '/p' || CAST(uid % 7 AS VARCHAR) AS page,
    '/' || et AS route,
    CASE WHEN et = 'click' THEN '#btn-' || CAST(n % 11 AS VARCHAR) END AS element,
    CASE WHEN n % 10 = 0 THEN NULL
         WHEN n % 20 = 5 THEN strftime(t0 - INTERVAL 1 SECOND, {ISO})
         WHEN n % 15 = 0 THEN strftime(t0 + INTERVAL 1 SECOND, {ISO})
         ELSE strftime(t0, {ISO}) END AS ts,
    FALSE AS m_null,
    'edge' AS m_browser,
    CASE WHEN n % 7 = 0 THEN 'spring-' || CAST(k % 5 AS VARCHAR) END AS m_campaign,
    CAST(NULL AS VARCHAR) AS m_country,
    CASE WHEN n % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS m_device,
    k AS m_k,
    CASE WHEN uid % 2 = 0 THEN 'linux' ELSE 'ios' END AS m_os,
    CASE WHEN et = 'view' THEN 'q' || CAST(k AS VARCHAR) ELSE '' END AS m_search_term,
    t0 + INTERVAL 2 HOUR AS _ingested_at
  FROM ev WHERE n % 5 = 0)"""

# struct -> JSON text the way Spark's to_json writes it (NULL fields omitted)
_META_JSON = """CASE WHEN m_null THEN NULL ELSE '{' || concat_ws(',',
      '"browser":"' || m_browser || '"', '"campaign":"' || m_campaign || '"',
      '"country":"' || m_country || '"', '"device":"' || m_device || '"',
      '"k":' || CAST(m_k AS VARCHAR), '"os":"' || m_os || '"',
      '"search_term":"' || m_search_term || '"') || '}' END"""


def _bronze_clicks(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT event_id, user_id, session_id, event_type, page, route, element,
         try_strptime(ts, {ISO}) AS ts, _ingested_at, {_META_JSON} AS metadata_json
  FROM {src})"""


def _silver_clicks(name: str, src: str, processed: str = RUN_TS) -> str:
    return f"""{name}_norm AS (
  SELECT event_id, user_id, session_id, lower(trim(event_type)) AS event_type,
         regexp_replace(trim(page), '//+', '/', 'g') AS page_path,
         regexp_replace(trim(route), '//+', '/', 'g') AS route_path,
         element, ts AS ts_utc,
         json_extract_string(metadata_json, '$.browser') AS browser,
         json_extract_string(metadata_json, '$.os') AS os,
         json_extract_string(metadata_json, '$.device') AS device,
         json_extract_string(metadata_json, '$.country') AS country,
         json_extract_string(metadata_json, '$.campaign') AS campaign,
         metadata_json, _ingested_at
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE (rn), {processed} AS _processed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                                 ORDER BY ts_utc DESC NULLS LAST, _ingested_at DESC NULLS LAST) AS rn
    FROM {name}_norm) WHERE rn = 1)"""


CLICKS = ",\n".join([
    _EV, _RAW_D1, _RAW_D2,
    "raw_clicks AS (SELECT * FROM raw_d1 UNION ALL SELECT * FROM raw_d2)",
    _bronze_clicks("bronze_clicks", "raw_clicks"),
])

BRONZE_ORDERS = f"""bronze_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS user_id,
         CASE WHEN o_orderkey % 3 = 0 THEN '  ' || o_orderstatus || ' '
              WHEN o_orderkey % 3 = 1 THEN lower(o_orderstatus)
              ELSE o_orderstatus END AS status,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total_amount,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS created_at,
         CASE WHEN o_orderkey % 26 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS updated_at,
         {RUN_TS} AS _ingested_at
  FROM orders)"""


def _silver_orders(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT order_id, user_id AS customer_id, lower(trim(status)) AS status,
         CAST(total_amount AS DECIMAL(18,2)) AS amount, CAST(NULL AS VARCHAR) AS currency,
         coalesce(created_at, updated_at) AS order_ts_utc, _ingested_at,
         {RUN_TS} AS _processed_at
  FROM {src})"""


ITEMS = f"""items AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 103 = 0 THEN '' ELSE p_name END AS name,
         p_brand AS sku,
         CAST(CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN -1
                   ELSE p_size END AS INTEGER) AS quantity,
         p_type AS location, {RUN_TS} AS updated_at
  FROM part)"""


def _chg(cls: int, step: int, op: str, id_: str, name: str, sku: str, qty: str, loc: str) -> str:
    return (f"SELECT p_partkey * 10 + {step} AS seq, '{op}' AS op, CAST({id_} AS BIGINT) AS id, "
            f"{name} AS name, {sku} AS sku, CAST({qty} AS INTEGER) AS quantity, {loc} AS location "
            f"FROM part WHERE p_partkey % 10 = {cls}")


_N, _I = "CAST(NULL AS VARCHAR)", "CAST(NULL AS INTEGER)"
CHANGES = "changes AS (\n  " + "\n  UNION ALL ".join([
    _chg(0, 1, "delete", "p_partkey", _N, _N, _I, _N),
    _chg(1, 1, "update", "p_partkey", "CASE WHEN p_partkey % 30 = 1 THEN '' ELSE upper(p_name) END",
         "p_brand", "p_size - 3", "p_type"),
    _chg(2, 1, "update", "p_partkey", "p_name", "p_brand", "p_size + 1", "p_type"),
    _chg(2, 2, "delete", "p_partkey", _N, _N, _I, _N),
    _chg(3, 1, "delete", "p_partkey", _N, _N, _I, _N),
    _chg(3, 2, "update", "p_partkey", "p_name", "p_brand", "p_size", "p_type"),
    _chg(4, 1, "update", "p_partkey", "'first'", "p_brand", "1", "p_type"),
    _chg(4, 2, "update", "p_partkey", "p_name", "p_brand", "0", _N),
    _chg(5, 1, "create", "NULL", "'new ' || p_name", "p_brand", "p_size % 7",
         "'WH-' || CAST(p_partkey % 4 AS VARCHAR)"),
    _chg(6, 1, "create", "p_partkey", "p_name", "p_brand", "p_size", "p_type"),
    _chg(7, 1, "update", "-p_partkey - 1", "p_name", "p_brand", "p_size", "p_type"),
    _chg(8, 1, "delete", "-p_partkey - 1", _N, _N, _I, _N),
]) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_META_COLS = ", ".join(f"m_{f} AS metadata_{f}" for f in
                       ("browser", "campaign", "country", "device", "k", "os", "search_term"))

_GOLD_DAILY = """SELECT CAST(created_at AS DATE) AS order_date, COUNT(DISTINCT order_id) AS orders,
       CAST(SUM(total_amount) AS DECIMAL(22,2)) AS revenue
FROM bronze_orders GROUP BY 1"""

_DIM_USER = """SELECT user_id, CAST(user_id AS VARCHAR) AS user_key FROM (
  SELECT user_id FROM silver_clicks WHERE user_id IS NOT NULL
  UNION SELECT user_id FROM bronze_orders WHERE user_id IS NOT NULL)"""

_FACT_CLICKS = """SELECT session_id, user_id, page_path AS page, lower(trim(event_type)) AS event_type,
       CAST(strftime(ts_utc, '%Y%m%d') AS INTEGER) AS event_date_key,
       COUNT(DISTINCT event_id) AS events_count
FROM silver_clicks GROUP BY 1, 2, 3, 4, 5"""

_FACT_ORDERS = """SELECT order_id, user_id,
       CAST(CASE WHEN total_amount IS NOT NULL THEN 1 END AS INTEGER) AS product_count,
       total_amount, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS order_date_key,
       lower(trim(status)) AS status
FROM bronze_orders"""

_APPLY = f"""per_id AS (
  SELECT id, bool_or(op = 'delete') AS deleted,
         max(CASE WHEN op = 'update' THEN seq END) AS upd_seq
  FROM changes WHERE op IN ('update', 'delete') AND id IS NOT NULL GROUP BY id),
upd AS (SELECT c.* FROM changes c JOIN per_id p ON c.id = p.id AND c.seq = p.upd_seq),
kept AS (
  SELECT s.id,
         CASE WHEN u.id IS NOT NULL THEN u.name ELSE s.name END AS name,
         CASE WHEN u.id IS NOT NULL THEN u.sku ELSE s.sku END AS sku,
         CASE WHEN u.id IS NOT NULL THEN u.quantity ELSE s.quantity END AS quantity,
         CASE WHEN u.id IS NOT NULL THEN u.location ELSE s.location END AS location,
         CASE WHEN u.id IS NOT NULL THEN {RUN_TS2} ELSE s.updated_at END AS updated_at
  FROM items s LEFT JOIN per_id p ON s.id = p.id LEFT JOIN upd u ON s.id = u.id
  WHERE p.deleted IS NULL OR NOT p.deleted),
created AS (
  SELECT (SELECT coalesce(max(id), 0) FROM items) + row_number() OVER (ORDER BY seq) AS id,
         name, sku, quantity, location, {RUN_TS2} AS updated_at
  FROM changes WHERE op = 'create' AND id IS NULL)"""

_VALIDITY = """SELECT seq, op, id, reason IS NULL AS valid, reason FROM (
  SELECT seq, op, id,
    CASE WHEN op IS NULL OR op NOT IN ('create', 'update', 'delete') THEN 'unknown_op'
         WHEN op = 'create' AND id IS NOT NULL THEN 'create_with_id'
         WHEN op IN ('update', 'delete') AND id IS NULL THEN 'missing_id'
         WHEN op IN ('create', 'update') AND (name IS NULL OR name = '') THEN 'missing_name'
         WHEN op IN ('create', 'update') AND (sku IS NULL OR sku = '') THEN 'missing_sku'
         WHEN op IN ('create', 'update') AND quantity IS NULL THEN 'missing_quantity'
         WHEN op IN ('create', 'update') AND (location IS NULL OR location = '') THEN 'missing_location'
         WHEN op IN ('create', 'update') AND quantity < 0 THEN 'negative_quantity'
    END AS reason
  FROM changes)"""

_NUM = "CAST(substr(event_id, 2) AS BIGINT)"

# the pipeline run: every table's content as SQL
_RUN = ",\n".join([
    CLICKS, BRONZE_ORDERS,
    _silver_clicks("silver_all", "bronze_clicks"),
    "silver_clicks AS (SELECT * FROM silver_all WHERE event_id IS NOT NULL)",
    "rejected AS (SELECT * FROM silver_all_norm WHERE event_id IS NULL)",
    f"dim_user AS ({_DIM_USER})",
    f"fact_orders AS ({_FACT_ORDERS})",
    f"fact_clicks AS ({_FACT_CLICKS})",
    f"daily AS ({_GOLD_DAILY})",
])


def _rows(layer: str, table: str, src: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{table}' AS \"table\", 'rows' AS metric, "
            f"CAST(count(*) AS BIGINT) AS value FROM {src}")


def _keys(layer: str, table: str, src: str, key: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{table}' AS \"table\", TRUE AS schema_ok, "
            f"CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(count(*) FILTER (WHERE {key} IS NULL) AS BIGINT) AS null_keys, "
            f"CAST((SELECT count(*) FROM (SELECT {key} FROM {src} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING count(*) > 1)) AS BIGINT) AS duplicate_keys FROM {src}")


SQL: dict[str, str] = {
    "bronze_clicks": _with(CLICKS) + "SELECT * FROM bronze_clicks",
    "bronze_clicks_raw": _with(CLICKS) + (
        "SELECT event_id, user_id, session_id, event_type, page, route, element, ts, "
        f"_ingested_at, {_META_COLS} FROM raw_clicks"),
    "bronze_orders": _with(BRONZE_ORDERS) + "SELECT * FROM bronze_orders",
    "scan_jsonl_clicks": _with(CLICKS) + (
        "SELECT event_id, user_id, session_id, event_type, page, route, element, ts, "
        f"{_META_COLS} FROM raw_clicks"),
    "bronze_append": _with(CLICKS) + "SELECT * FROM bronze_clicks",
    "clean_status": _with(BRONZE_ORDERS) + "SELECT order_id, lower(trim(status)) AS status FROM bronze_orders",
    "clean_paths": "SELECT page_id, regexp_replace(trim(url), '//+', '/', 'g') AS url_path FROM pages",
    "json_extract": _with(CLICKS) + (
        "SELECT event_id, _ingested_at, "
        + ", ".join(f"json_extract_string(metadata_json, '$.{f}') AS {f}"
                    for f in ("browser", "os", "device", "country", "campaign", "search_term"))
        + " FROM bronze_clicks"),
    "silver_orders": _with(BRONZE_ORDERS, _silver_orders("silver_orders", "bronze_orders"))
        + "SELECT * FROM silver_orders",
    "silver_orders_dedup": _with(BRONZE_ORDERS, f"""redelivered AS (
  SELECT * FROM bronze_orders
  UNION ALL
  SELECT o_orderkey, o_custkey, ' Returned',
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)),
         CASE WHEN o_orderkey % 14 = 0 THEN o_orderdate + INTERVAL 2 DAY
              WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderdate END,
         CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END,
         {REDELIVERY_TS}
  FROM orders WHERE o_orderkey % 7 = 0)""", _silver_orders("staged", "redelivered")) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
                               ORDER BY order_ts_utc DESC NULLS LAST, _ingested_at DESC NULLS LAST) AS rn
  FROM staged) WHERE rn = 1""",
    "schema_tolerant_orders": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       lower(trim(o_orderstatus)) AS status, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS amount,
       CAST(NULL AS VARCHAR) AS currency,
       TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END
                AS TIMESTAMP) AS order_ts_utc,
       CAST(NULL AS TIMESTAMP) AS _ingested_at, {RUN_TS} AS _processed_at
FROM orders""",
    "scan_open_clicks": _with(_EV) + """SELECT
  CASE WHEN n % 50 = 7 THEN NULL ELSE 'e' || CAST(n AS VARCHAR) END AS event_id,
  CASE WHEN n % 50 = 7 THEN NULL ELSE uid END AS user_id,
  CASE WHEN n % 50 = 7 THEN '{"_malformed":"no json ' || CAST(n AS VARCHAR) || '"}'
       ELSE '{"plan":"p' || CAST(k % 3 AS VARCHAR) || '","k":"' || CAST(k AS VARCHAR)
            || 'x","tags":["a",' || CAST(uid AS VARCHAR) || ']}' END AS metadata_json
FROM ev""",
    "rejected_clicks": _with(CLICKS, _silver_clicks("silver_clicks", "bronze_clicks"))
        + f"SELECT *, {RUN_TS} AS _processed_at FROM silver_clicks_norm WHERE event_id IS NULL",
    "silver_clicks": _with(CLICKS, _silver_clicks("silver_clicks", "bronze_clicks"))
        + "SELECT * FROM silver_clicks",
    "upsert_orders": _with(BRONZE_ORDERS, _silver_orders("base", "bronze_orders"), f"""src AS (
  SELECT order_id, customer_id, CASE WHEN order_id % 8 = 0 THEN NULL ELSE status END AS status,
         CAST(amount + 10 AS DECIMAL(18,2)) AS amount, currency, order_ts_utc, _ingested_at,
         {RUN_TS2} AS _processed_at
  FROM base WHERE order_id % 3 = 0 OR order_id % 2 = 0)""") + """
SELECT * FROM src
UNION ALL
SELECT * FROM base t WHERE t.order_id % 3 <> 0
  AND NOT EXISTS (SELECT 1 FROM src s WHERE s.order_id = t.order_id)""",
    "upsert_clicks": _with(
        CLICKS, _bronze_clicks("bronze_d1", "raw_d1"),
        _silver_clicks("tgt_all", "bronze_d1"),
        _silver_clicks("src_all", "bronze_clicks", RUN_TS2)) + f"""
SELECT * FROM src_all WHERE {_NUM} % 3 = 0 OR {_NUM} % 2 = 0
UNION ALL
SELECT * FROM tgt_all t WHERE {_NUM} % 3 <> 0
  AND NOT EXISTS (SELECT 1 FROM src_all s
                  WHERE (CAST(substr(s.event_id, 2) AS BIGINT) % 3 = 0
                         OR CAST(substr(s.event_id, 2) AS BIGINT) % 2 = 0)
                    AND s.event_id = t.event_id)""",
    "gold_dim_user": _with(CLICKS, BRONZE_ORDERS, _silver_clicks("silver_clicks", "bronze_clicks"))
        + _DIM_USER,
    "gold_fact_orders": _with(BRONZE_ORDERS) + _FACT_ORDERS,
    "gold_fact_clicks": _with(CLICKS, _silver_clicks("silver_clicks", "bronze_clicks")) + _FACT_CLICKS,
    "gold_orders_daily_revenue": _with(BRONZE_ORDERS) + _GOLD_DAILY,
    "report_daily_revenue": _with(BRONZE_ORDERS) + _GOLD_DAILY + " ORDER BY order_date",
    "items_snapshot": _with(ITEMS) + "SELECT * FROM items",
    "items_lookup": _with(ITEMS) + (
        "SELECT * FROM items WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)"),
    "items_low_stock": _with(ITEMS) + (
        "SELECT id, quantity, coalesce(quantity < 5, FALSE) AS low_stock FROM items"),
    "items_validity": _with(CHANGES) + _VALIDITY,
    "items_apply_changes": _with(ITEMS, CHANGES, _APPLY)
        + "SELECT * FROM kept UNION ALL SELECT * FROM created",
    "stream_silver_clicks": _with(CLICKS, _silver_clicks("silver_clicks", "bronze_clicks"))
        + "SELECT * FROM silver_clicks WHERE event_id IS NOT NULL",
    "run_audit": _with(_RUN) + "\nUNION ALL ".join([
        _rows("bronze", "orders", "bronze_orders"),
        _rows("bronze", "click_events", "raw_clicks"),
        _rows("silver", "orders", "bronze_orders"),
        _rows("silver", "click_events", "silver_clicks"),
        _rows("silver", "click_events_rejected", "rejected"),
        _rows("gold", "dim_user", "dim_user"),
        _rows("gold", "fact_orders", "fact_orders"),
        _rows("gold", "fact_clicks", "fact_clicks"),
        _rows("gold", "orders_daily_revenue", "daily"),
    ]),
    "contract_check": _with(_RUN) + "\nUNION ALL ".join([
        _keys("bronze", "orders", "bronze_orders", "order_id"),
        _keys("silver", "orders", "bronze_orders", "order_id"),
        _keys("silver", "click_events", "silver_clicks", "event_id"),
        _keys("gold", "dim_user", "dim_user", "user_id"),
        _keys("gold", "fact_orders", "fact_orders", "order_id"),
        _keys("gold", "orders_daily_revenue", "daily", "order_date"),
    ]),
}

# the daily mart of orders and their re-deliveries
SQL["gold_daily_loads"] = _with(BRONZE_ORDERS, """delivered AS (
  SELECT order_id, total_amount, created_at FROM bronze_orders
  UNION ALL
  SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)),
         CASE WHEN o_orderkey % 14 = 0 THEN o_orderdate + INTERVAL 2 DAY
              WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderdate END
  FROM orders WHERE o_orderkey % 7 = 0)""") + _GOLD_DAILY.replace("bronze_orders", "delivered")

# the stored form of the same upsert
SQL["upsert_orders_buckets"] = SQL["upsert_orders"]

# open metadata
SQL["metadata_at"] = _with(_EV) + """SELECT
  CASE WHEN n % 50 = 7 THEN NULL ELSE 'e' || CAST(n AS VARCHAR) END AS event_id,
  CASE WHEN n % 50 = 7 THEN NULL ELSE 'p' || CAST(k % 3 AS VARCHAR) END AS plan,
  CASE WHEN n % 50 = 7 THEN NULL ELSE CAST(k AS VARCHAR) || 'x' END AS k,
  CAST(NULL AS BIGINT) AS k_number,
  CASE WHEN n % 50 = 7 THEN NULL ELSE 'a' END AS tag,
  CASE WHEN n % 50 = 7 THEN NULL ELSE uid END AS tag_user,
  CAST(NULL AS VARCHAR) AS absent,
  CASE WHEN n % 50 = 7 THEN 'no json ' || CAST(n AS VARCHAR) END AS malformed
FROM ev"""
SQL["metadata_report"] = _with(_EV) + """SELECT path, rows, type FROM (
  SELECT p.path, CAST(count(*) * p.times AS BIGINT) AS rows, p.type
  FROM ev JOIN (VALUES ('$.plan', FALSE, 1, 'STRING'), ('$.k', FALSE, 1, 'STRING'), ('$.tags', FALSE, 1, 'ARRAY<VARIANT>'),
                       ('$.tags[*]', FALSE, 2, 'VARIANT'), ('$._malformed', TRUE, 1, 'STRING')) p(path, bad, times, type)
    ON (n % 50 = 7) = p.bad
  GROUP BY p.path, p.times, p.type)"""

# the feed of four shapes: which time decides depends on the shape
SQL["orders_of_shapes"] = f"""SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 4 <> 2 THEN o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 4 = 3 AND o_orderkey % 13 = 0 THEN '' ELSE lower(trim(o_orderstatus)) END AS status,
  CASE WHEN o_orderkey % 4 = 2 AND o_orderkey % 7 = 0 THEN NULL
       ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) END AS amount,
  CASE WHEN o_orderkey % 4 = 3 THEN 'EUR' END AS currency,
  CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 11 <> 0 THEN date_trunc('day', o_orderdate)
       WHEN o_orderkey % 4 <= 1 THEN o_orderdate + INTERVAL 3 HOUR
       WHEN o_orderkey % 4 = 2 THEN o_orderdate + INTERVAL 1 DAY
       ELSE o_orderdate + INTERVAL 2 DAY END AS order_ts_utc,
  CAST(NULL AS TIMESTAMP) AS _ingested_at, {RUN_TS} AS _processed_at
FROM orders"""
SQL["orders_shape_conflicts"] = """SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 4 = 1 THEN 'order_date'
       WHEN o_orderkey % 4 = 2 AND o_orderkey % 7 = 0 THEN 'amount' ELSE '' END AS conflicts
FROM orders"""

# snapshots: an order counts as changed only if a value of it did
SQL["orders_changes"] = _with(BRONZE_ORDERS) + """SELECT order_id, CASE order_id % 50 WHEN 1 THEN 'insert' ELSE 'update' END AS op
FROM bronze_orders
WHERE order_id % 50 = 1 OR order_id % 50 = 2 AND total_amount IS NOT NULL
   OR order_id % 50 = 3 AND created_at IS NOT NULL
UNION ALL SELECT -order_id, 'delete' FROM bronze_orders WHERE order_id % 50 = 4"""
SQL["gold_orders_refresh"] = SQL["gold_fact_orders"]
SQL["gold_daily_refresh"] = SQL["gold_orders_daily_revenue"]

# every delivery is stored, superseded by a later one of its key, or rejected
SQL["run_reconcile"] = _with(_RUN) + """SELECT 'raw' AS part, CAST(count(*) AS BIGINT) AS rows FROM raw_clicks
UNION ALL SELECT 'stored', count(DISTINCT event_id) FROM raw_clicks
UNION ALL SELECT 'superseded', count(event_id) - count(DISTINCT event_id) FROM raw_clicks
UNION ALL SELECT 'rejected', count(*) FROM raw_clicks WHERE event_id IS NULL
UNION ALL SELECT fault, 0 FROM (VALUES ('lost'), ('doubled'), ('foreign'), ('stale'), ('unkeyed')) f(fault)"""
SQL["catalog_tables"] = f"SELECT layer, \"table\", value AS rows FROM ({SQL['run_audit']})"
