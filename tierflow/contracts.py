"""Table contracts: one explicit StructType per layer table, plus keys.

All timestamps are ``timestamp_ntz`` holding UTC wall-clock time, which is
what a zone-less DATETIME column means and what parquet files carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# JSON-lines click record as it lands (A1).  metadata is open: its JSON text
# is kept as it is, whatever keys and types it has.
RAW_CLICK = _schema(("event_id", S), ("user_id", L), ("session_id", S),
                    ("event_type", S), ("page", S), ("route", S), ("element", S),
                    ("ts", S), ("metadata", S))

# A landed click file may carry the delivery time stamped by the collector.
LANDED_CLICK = T.StructType(RAW_CLICK.fields + [T.StructField("_ingested_at", TS, True)])

BRONZE_ORDERS = _schema(("order_id", L), ("user_id", L), ("status", S),
                        ("total_amount", T.DecimalType(12, 2)), ("created_at", TS),
                        ("updated_at", TS), ("_ingested_at", TS))

BRONZE_CLICKS = _schema(("event_id", S), ("user_id", L), ("session_id", S),
                        ("event_type", S), ("page", S), ("route", S), ("element", S),
                        ("ts", TS), ("_ingested_at", TS), ("metadata_json", S))

SILVER_ORDERS = _schema(("order_id", L), ("customer_id", L), ("status", S),
                        ("amount", T.DecimalType(18, 2)), ("currency", S),
                        ("order_ts_utc", TS), ("_ingested_at", TS), ("_processed_at", TS))

SILVER_CLICKS = _schema(("event_id", S), ("user_id", L), ("session_id", S),
                        ("event_type", S), ("page_path", S), ("route_path", S),
                        ("element", S), ("ts_utc", TS), ("browser", S), ("os", S),
                        ("device", S), ("country", S), ("campaign", S),
                        ("metadata_json", S), ("_ingested_at", TS), ("_processed_at", TS))

DIM_USER = _schema(("user_id", L), ("user_key", S))

FACT_ORDERS = _schema(("order_id", L), ("user_id", L), ("product_count", I),
                      ("total_amount", T.DecimalType(12, 2)), ("order_date_key", I),
                      ("status", S))

FACT_CLICKS = _schema(("session_id", S), ("user_id", L), ("page", S),
                      ("event_type", S), ("event_date_key", I), ("events_count", L))

# a feed of orders from systems of several ages (``sources.shapes``)
ORDERS_FEED = _schema(("order_id", L), ("customer_id", L), ("status", S), ("amount", T.DecimalType(18, 2)),
                      ("currency", S), ("order_date", TS), ("order_ts", TS), ("created_at", TS),
                      ("updated_at", TS), ("_ingested_at", TS))

ORDERS_DAILY_REVENUE = _schema(("order_date", T.DateType()), ("orders", L),
                               ("revenue", T.DecimalType(22, 2)))

# what each load of orders adds to the daily mart (bitmaps of order ids)
ORDERS_DAILY_STATE = _schema(("order_date", T.DateType()), ("id_block", L), ("ids", T.BinaryType()),
                             ("revenue", T.DecimalType(22, 2)))

ITEMS = _schema(("id", L), ("name", S), ("sku", S), ("quantity", I),
                ("location", S), ("updated_at", TS))

ITEM_CHANGES = _schema(("seq", L), ("op", S), ("id", L), ("name", S), ("sku", S),
                       ("quantity", I), ("location", S))

# (layer, table) -> (schema, key columns, storage partition columns)
TABLES: dict[tuple[str, str], tuple[T.StructType, list[str], list[str]]] = {
    ("bronze", "orders"): (BRONZE_ORDERS, ["order_id"], []),
    ("bronze", "click_events"): (BRONZE_CLICKS, [], ["_ingest_date"]),
    ("silver", "orders"): (SILVER_ORDERS, ["order_id"], []),
    ("silver", "click_events"): (SILVER_CLICKS, ["event_id"], ["_event_date", "_undated"]),
    ("silver", "click_events_rejected"): (SILVER_CLICKS, [], []),
    ("gold", "dim_user"): (DIM_USER, ["user_id"], []),
    ("gold", "fact_orders"): (FACT_ORDERS, ["order_id"], ["order_month"]),
    ("gold", "fact_clicks"): (FACT_CLICKS, [], ["event_month"]),
    ("gold", "orders_daily_revenue"): (ORDERS_DAILY_REVENUE, ["order_date"], ["state_month"]),
    ("gold", "orders_daily_state"): (ORDERS_DAILY_STATE, [], ["state_month"]),
    ("app", "inventory_items"): (ITEMS, ["id"], []),
}

# Storage-only partition columns, derived from contract columns when a
# table is written (and dropped again by ``conform`` on read).  Facts are
# partitioned by month and sorted by day inside it: a day filter prunes
# folders by month and row groups by the day key's min/max statistics,
# without one folder (and at least one file) per day.
#
# Events without a time have no day to lie in: they are kept by ingest day
# and a hash part of the key, so that a load rewrites those of its own day
# and never the undated rows of all time.  ``_undated`` is '-' for the others.
UNDATED_PARTS = 16
PARTITION_EXPRS: dict[str, str] = {
    "_ingest_date": "to_date(_ingested_at)",
    "_event_date": "to_date(ts_utc)",
    "_undated": "IF(ts_utc IS NOT NULL, '-', concat(coalesce(date_format(_ingested_at, 'yyyy-MM-dd'), 'none'), '.', "
                f"lpad(cast(pmod(xxhash64(event_id), {UNDATED_PARTS}) AS string), 2, '0')))",
    "state_month": "year(order_date) * 100 + month(order_date)",
    "order_month": "CAST(order_date_key DIV 100 AS INT)",
    "event_month": "CAST(event_date_key DIV 100 AS INT)",
}
# Tables whose rows are spread over many partition values in every task
# (aggregates, and silver rows spread over event days): one REBALANCE
# shuffle before the write gives about one file per partition value and
# advisory size, where writing as-is would give one file per task *and*
# value (1,000 tasks x 365 days = 365k files).  AQE splits a hot value over
# several files.  Bronze appends carry one or two ingest days per load and
# are written as they come.
REBALANCE_ON_WRITE = {("gold", "fact_orders"), ("gold", "fact_clicks"),
                      ("silver", "click_events"), ("gold", "orders_daily_state"),
                      ("gold", "orders_daily_revenue")}
# Append-only tables with a folder per load (storage-only partition column
# ``_load_seq``): readers list the folders of committed loads only, and an
# incremental reader those after the last one it processed.
LOAD_SEQUENCED = {("bronze", "click_events"), ("silver", "click_events_rejected"), ("gold", "orders_daily_state")}
# Tables stored in buckets of their key: number of buckets.  An upsert merges
# them bucket by bucket; size it so that a bucket of the table is some 100 MB
# (the layout of a table is fixed by its first version).
BUCKETS: dict[tuple[str, str], int] = {("silver", "orders"): 32}
# Types of the storage partition columns (declared, never inferred: a
# version holding only NULL partition values would otherwise read as VOID).
PARTITION_TYPES: dict[str, T.DataType] = {
    "_load_seq": T.LongType(), "_ingest_date": T.DateType(), "_event_date": T.DateType(),
    "order_month": T.IntegerType(), "event_month": T.IntegerType(),
    "state_month": T.IntegerType(), "_undated": T.StringType(),
}
# Sort order inside the files of each stored table (for row-group pruning).
SORT_WITHIN: dict[tuple[str, str], list[str]] = {
    ("gold", "fact_orders"): ["order_date_key"],
    ("gold", "fact_clicks"): ["event_date_key"],
}


def stored_schema(layer: str, table: str) -> T.StructType:
    """The schema of a table's files as stored: contract columns, the load
    sequence column of sequenced tables, then the partition columns."""
    schema, _, parts = TABLES[(layer, table)]
    fields = list(schema.fields)
    if (layer, table) in LOAD_SEQUENCED:
        fields.append(T.StructField("_load_seq", T.LongType(), True))
    fields += [T.StructField(p, PARTITION_TYPES[p], True) for p in parts]
    return T.StructType(fields)


def schema_of(layer: str, table: str) -> T.StructType:
    return TABLES[(layer, table)][0]


def keys_of(layer: str, table: str) -> list[str]:
    return TABLES[(layer, table)][1]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the contract: contract order, contract types.

    A missing column is an error; use ``col_or_null`` upstream when a
    source may legitimately lack a column.
    """
    have = {f.name: f.dataType for f in df.schema.fields}   # one schema fetch
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"columns missing for contract: {missing}")
    if [f.name for f in schema.fields] == list(have) and all(
            have[f.name] == f.dataType for f in schema.fields):
        return df
    cols: list[Column] = []
    for f in schema.fields:
        c = F.col(f.name)
        if have[f.name] != f.dataType:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty(spark, schema: T.StructType) -> DataFrame:
    """An empty frame with the contract schema (a missing table reads as this)."""
    return spark.createDataFrame([], schema)


def ddl(layer: str, table: str, location: str | None = None, database: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a contract (B5): the schema,
    storage partition columns and, optionally, a location.  The database is
    the layer's, or ``database``."""
    schema, keys, parts = TABLES[(layer, table)]
    if (layer, table) in LOAD_SEQUENCED:
        parts = ["_load_seq", *parts]
    cols = [f"  {f.name} {f.dataType.simpleString().upper()}" for f in schema.fields]
    cols += [f"  {p} {PARTITION_TYPES[p].simpleString().upper()}" for p in parts]
    text = f"CREATE TABLE IF NOT EXISTS {database or layer}.{table} (\n" + ",\n".join(cols) + "\n) USING parquet"
    if parts:
        text += f"\nPARTITIONED BY ({', '.join(parts)})"
    if (layer, table) in BUCKETS:
        by = ", ".join(keys)
        text += f"\nCLUSTERED BY ({by}) SORTED BY ({by}) INTO {BUCKETS[layer, table]} BUCKETS"
    if keys:
        text += f"\nCOMMENT 'key: {', '.join(keys)}'"
    if location:
        text += f"\nLOCATION '{location}'"
    return text
