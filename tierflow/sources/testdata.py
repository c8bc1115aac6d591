"""Adapters: the driver's tables -> the raw layers this library consumes.

The driver tables are clean (unique keys, no NULLs, lower-case types), so
the adapters inject the dirt the pipeline exists to handle: re-deliveries,
padding and case noise, NULLs, unparsable times, doubled slashes.  All of
it is a pure function of the row's key, written with expressions that an
independent SQL engine computes identically (the oracle in ``tierflow_oracle.py``
mirrors every rule here).  Everything scales with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# ---- fixed values -------------------------------------------------------
RUN_TS = "2025-01-01 00:00:00"          # load stamp of the reproducible runs
REDELIVERY_TS = "2025-01-02 00:00:00"   # load stamp of re-delivered orders
# -------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sel(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Project with SQL expressions (one call per projection)."""
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols.items()])


# zone-free 'yyyy-MM-ddTHH:mm:ssZ' of a timestamp_ntz expression
def _iso(ts: str) -> str:
    return f"concat(replace(substring(CAST({ts} AS STRING), 1, 19), ' ', 'T'), 'Z')"


_EV = ("event_id AS n", "user_id AS uid", "event_type AS et", "ts AS t0",
       "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")


def _click_common() -> dict[str, str]:
    return {
        "event_id": "CASE WHEN n % 1000 = 999 THEN NULL ELSE 'e' || CAST(n AS STRING) END",
        "session_id": "'s-' || CAST(uid AS STRING) || '-' || CAST(n % 3 AS STRING)",
        "element": "CASE WHEN et = 'click' THEN '#btn-' || CAST(n % 11 AS STRING) END",
    }


def _meta(browser: str, device: str) -> str:
    return f"""named_struct(
        'browser', {browser},
        'campaign', CASE WHEN n % 7 = 0 THEN 'spring-' || CAST(k % 5 AS STRING) END,
        'country', CAST(NULL AS STRING),
        'device', {device},
        'k', k,
        'os', CASE WHEN uid % 2 = 0 THEN 'linux' ELSE 'ios' END,
        'search_term', CASE WHEN et = 'view' THEN 'q' || CAST(k AS STRING) ELSE '' END)"""


_CLICK_ORDER = ["event_id", "user_id", "session_id", "event_type", "page", "route",
                "element", "ts", "metadata", "_ingested_at"]


def raw_clicks(spark: SparkSession, sf_dir: str, deliveries: str = "all") -> DataFrame:
    """Raw click records (``contracts.RAW_CLICK`` + ``_ingested_at``).

    First delivery: every event.  Second delivery: every 5th event again,
    with cleaner text, another device and a time that is NULL (every 10th),
    one second earlier (n % 20 = 5), one second later (n % 15 = 0) or equal
    (ties then go to the later ``_ingested_at``).
    deliveries: "all", "first" or "second".
    """
    ev = table(spark, sf_dir, "events").selectExpr(*_EV)
    p7 = "CAST(uid % 7 AS STRING)"
    first = dict(_click_common(), **{
        "user_id": "CASE WHEN n % 17 = 0 THEN NULL ELSE uid END",
        "event_type": """CASE WHEN n % 97 = 0 THEN char(9) || et
                              WHEN n % 4 = 0 THEN '  ' || upper(et) || ' '
                              WHEN n % 4 = 1 THEN upper(et) ELSE et END""",
        "page": f"""CASE WHEN n % 3 = 0 THEN ' //' || et || '///p' || {p7} || ' '
                         ELSE '/' || et || '/p' || {p7} END""",
        "route": f"""CASE WHEN n % 5 = 0 THEN '/' || et || '?next=http://shop.example.com//p' || {p7}
                          ELSE '//' || et || '//' END""",
        "ts": f"""CASE WHEN n % 13 = 0 THEN NULL WHEN n % 29 = 0 THEN 'not-a-time'
                       ELSE {_iso('t0')} END""",
        "metadata": f"""CASE WHEN n % 19 = 0 THEN NULL ELSE {_meta(
            "CASE WHEN n % 3 = 0 THEN 'chrome' WHEN n % 3 = 1 THEN 'firefox' ELSE 'safari' END",
            "CASE WHEN n % 2 = 0 THEN 'desktop' ELSE 'mobile' END")} END""",
        "_ingested_at": "t0 + INTERVAL 1 HOUR",
    })
    second = dict(_click_common(), **{
        "user_id": "uid",
        "event_type": "et",
        "page": f"'/' || et || '/p' || {p7}",
        "route": "'/' || et",
        "ts": f"""CASE WHEN n % 10 = 0 THEN NULL
                       WHEN n % 20 = 5 THEN {_iso('t0 - INTERVAL 1 SECOND')}
                       WHEN n % 15 = 0 THEN {_iso('t0 + INTERVAL 1 SECOND')}
                       ELSE {_iso('t0')} END""",
        "metadata": _meta("'edge'", "CASE WHEN n % 2 = 0 THEN 'mobile' ELSE 'desktop' END"),
        "_ingested_at": "t0 + INTERVAL 2 HOURS",
    })
    def struct(cols: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{c}', {cols[c]}" for c in _CLICK_ORDER) + ")"

    # one scan of events: each event yields its first delivery and, every
    # 5th event, a second one (exploded from an array of deliveries)
    wanted = []
    if deliveries in ("all", "first"):
        wanted.append(struct(first))
    if deliveries in ("all", "second"):
        wanted.append(f"CASE WHEN n % 5 = 0 THEN {struct(second)} END")
    return (ev.selectExpr(f"explode(array({', '.join(wanted)})) AS d")
              .where("d IS NOT NULL").selectExpr(*[f"d.{c} AS {c}" for c in _CLICK_ORDER]))


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text lines, one per event: metadata with keys no contract knows
    and a k that is no number; every 50th line is no JSON."""
    return table(spark, sf_dir, "events").selectExpr(*_EV).selectExpr(
        """CASE WHEN n % 50 = 7 THEN 'no json ' || CAST(n AS STRING)
                ELSE concat('{"event_id":"e', CAST(n AS STRING), '","user_id":', CAST(uid AS STRING),
                            ',"metadata":{"plan":"p', CAST(k % 3 AS STRING), '","k":"', CAST(k AS STRING),
                            'x","tags":["a",', CAST(uid AS STRING), ']}}') END AS value""")


_ORDER_COLS = ["order_id", "user_id", "status", "total_amount", "created_at", "updated_at"]


def oltp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OLTP ``orders`` table the bronze job snapshots (one row per order)."""
    return _sel(table(spark, sf_dir, "orders"), {
        "order_id": "o_orderkey",
        "user_id": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END",
        "status": """CASE WHEN o_orderkey % 3 = 0 THEN '  ' || o_orderstatus || ' '
                          WHEN o_orderkey % 3 = 1 THEN lower(o_orderstatus)
                          ELSE o_orderstatus END""",
        "total_amount": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END",
        "created_at": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END",
        "updated_at": "CASE WHEN o_orderkey % 26 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END",
    })


def bronze_orders_input(spark: SparkSession, sf_dir: str, redeliveries: bool = False) -> DataFrame:
    """OLTP orders stamped at RUN_TS; with ``redeliveries`` every 7th order
    arrives a second time (stamped a day later) with a new status and
    amount and a later (n % 14 = 0), equal, or missing (n % 21 = 0) time."""
    base = oltp_orders(spark, sf_dir).withColumn("_ingested_at", F.lit(RUN_TS).cast("timestamp_ntz"))
    if not redeliveries:
        return base
    again = _sel(table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0"), {
        "order_id": "o_orderkey",
        "user_id": "o_custkey",
        "status": "' Returned'",
        "total_amount": "CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2))",
        "created_at": """CASE WHEN o_orderkey % 14 = 0 THEN o_orderdate + INTERVAL 2 DAYS
                              WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderdate END""",
        "updated_at": "CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END",
        "_ingested_at": f"CAST('{REDELIVERY_TS}' AS TIMESTAMP_NTZ)",
    })
    return base.unionByName(again)


def earlier_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier snapshot of ``oltp_orders``; o_orderkey % 50 tells what
    became of an order since: 1 new (not here yet), 2 another amount, 3 moved
    by 40 days, 4 another one (negative id) is gone, else unchanged."""
    now = oltp_orders(spark, sf_dir).where("order_id % 50 <> 1").withColumns({
        "total_amount": F.expr("CAST(CASE WHEN order_id % 50 = 2 THEN total_amount + 1 ELSE total_amount END AS DECIMAL(12,2))"),
        "created_at": F.expr("CASE WHEN order_id % 50 = 3 THEN created_at - INTERVAL 40 DAYS ELSE created_at END")})
    gone = oltp_orders(spark, sf_dir).where("order_id % 50 = 4").withColumn("order_id", -F.col("order_id"))
    return now.unionByName(gone)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of orders as JSON lines (``value``) of four shapes, o_orderkey % 4:

    0 day as text in ``order_date`` (no day at all every 11th), a quoted id and
    amount, and all later times, too; 1 ``order_ts`` with a zone, but an
    ``order_date`` that is no date, and ``created_at``; 2 ``created_at`` and
    ``updated_at``, and an amount that is no number every 7th; 3 ``updated_at``
    alone, a currency, and an empty status every 13th."""
    def lines(*fields: str) -> str:
        return "to_json(named_struct(" + ", ".join(fields) + "))"

    day, iso = "substring(CAST(o_orderdate AS STRING), 1, 10)", _iso("o_orderdate + INTERVAL 3 HOURS")
    created, updated = _iso("o_orderdate + INTERVAL 1 DAY"), _iso("o_orderdate + INTERVAL 2 DAYS")
    key, amount = "o_orderkey", "CAST(o_totalprice AS DECIMAL(12,2))"
    return table(spark, sf_dir, "orders").selectExpr(f"""CASE o_orderkey % 4
        WHEN 0 THEN {lines(f"'order_id', CAST({key} AS STRING)", "'customer_id', o_custkey", "'status', o_orderstatus",
                           f"'amount', CAST({amount} AS STRING)", f"'order_date', CASE WHEN {key} % 11 <> 0 THEN {day} END",
                           f"'order_ts', {iso}", f"'created_at', {created}", f"'updated_at', {updated}")}
        WHEN 1 THEN {lines(f"'order_id', {key}", "'customer_id', o_custkey", "'status', o_orderstatus",
                           f"'amount', {amount}", "'order_date', 'unknown'", f"'order_ts', {iso}",
                           f"'created_at', {created}")}
        WHEN 2 THEN {lines(f"'order_id', {key}", "'status', '  ' || o_orderstatus || ' '",
                           f"'amount', CASE WHEN {key} % 7 = 0 THEN 'n/a' ELSE CAST({amount} AS STRING) END",
                           f"'created_at', {created}", f"'updated_at', {updated}")}
        ELSE {lines(f"'order_id', {key}", "'customer_id', CAST(o_custkey AS STRING) || '.0'",
                    f"'status', CASE WHEN {key} % 13 = 0 THEN '' ELSE o_orderstatus END",
                    f"'amount', {amount}", "'currency', 'EUR'", f"'updated_at', {updated}")} END AS value""",
        "o_orderkey % 4 AS shape")


def legacy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older orders feed with another shape: customer_id/amount named as
    in silver, the day as ``yyyy-MM-dd`` text in ``order_date``, and no
    currency/order_ts/created_at/updated_at/_ingested_at at all."""
    return _sel(table(spark, sf_dir, "orders"), {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "status": "o_orderstatus",
        "amount": "CAST(o_totalprice AS DECIMAL(12,2))",
        "order_date": """CASE WHEN o_orderkey % 11 = 0 THEN 'unknown'
                              ELSE substring(CAST(o_orderdate AS STRING), 1, 10) END""",
    })


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item snapshot from ``part`` (quantity NULL every 101st, -1 every 89th,
    blank name every 103rd)."""
    return _sel(table(spark, sf_dir, "part"), {
        "id": "p_partkey",
        "name": "CASE WHEN p_partkey % 103 = 0 THEN '' ELSE p_name END",
        "sku": "p_brand",
        "quantity": """CAST(CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN -1
                                 ELSE p_size END AS INT)""",
        "location": "p_type",
        "updated_at": f"CAST('{RUN_TS}' AS TIMESTAMP_NTZ)",
    })


# class = p_partkey % 10 -> (seq step, op, id, name, sku, quantity, location)
_NS, _NI = "CAST(NULL AS STRING)", "CAST(NULL AS INT)"
_CHANGES = [
    (0, 1, "delete", "p_partkey", _NS, _NS, _NI, _NS),
    (1, 1, "update", "p_partkey", "CASE WHEN p_partkey % 30 = 1 THEN '' ELSE upper(p_name) END",
     "p_brand", "p_size - 3", "p_type"),
    (2, 1, "update", "p_partkey", "p_name", "p_brand", "p_size + 1", "p_type"),
    (2, 2, "delete", "p_partkey", _NS, _NS, _NI, _NS),
    (3, 1, "delete", "p_partkey", _NS, _NS, _NI, _NS),
    (3, 2, "update", "p_partkey", "p_name", "p_brand", "p_size", "p_type"),
    (4, 1, "update", "p_partkey", "'first'", "p_brand", "1", "p_type"),
    (4, 2, "update", "p_partkey", "p_name", "p_brand", "0", _NS),
    (5, 1, "create", "NULL", "'new ' || p_name", "p_brand", "p_size % 7",
     "'WH-' || CAST(p_partkey % 4 AS STRING)"),
    (6, 1, "create", "p_partkey", "p_name", "p_brand", "p_size", "p_type"),
    (7, 1, "update", "-p_partkey - 1", "p_name", "p_brand", "p_size", "p_type"),
    (8, 1, "delete", "-p_partkey - 1", _NS, _NS, _NI, _NS),
]


def item_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change set derived from ``part``; class = p_partkey % 10:

    0 delete · 1 update · 2 update then delete · 3 delete then update ·
    4 two updates (the second sets location NULL) · 5 create ·
    6 create carrying an id · 7 update of an unknown id ·
    8 delete of an unknown id · 9 nothing.
    """
    # one scan of part: each row yields the changes of its class, exploded
    # from an array of (possibly NULL) change structs
    structs = [f"""CASE WHEN p_partkey % 10 = {cls} THEN named_struct(
                   'seq', p_partkey * 10 + {step}, 'op', '{op}', 'id', CAST({id_} AS BIGINT),
                   'name', {name}, 'sku', {sku}, 'quantity', CAST({qty} AS INT),
                   'location', {loc}) END"""
               for cls, step, op, id_, name, sku, qty, loc in _CHANGES]
    return (table(spark, sf_dir, "part")
            .selectExpr(f"explode(array({', '.join(structs)})) AS c")
            .where("c IS NOT NULL")
            .selectExpr(*[f"c.{f} AS {f}" for f in
                          ("seq", "op", "id", "name", "sku", "quantity", "location")]))


def wanted_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids asked for by a lookup: parts ordered in quantity > 45 (repeats
    and unknown ids included, as a real request log would have)."""
    return table(spark, sf_dir, "lineitem").where("l_quantity > 45").selectExpr("l_partkey AS id")
