"""Silver: cleaned, typed, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.functions.clean import (METADATA_PATHS, col_or_null, collapse_slashes,
                                      first_time, load_stamp, norm_lower, to_utc_ntz,
                                      typed_null, with_json_fields)
from tierflow.operators.dedup import latest_per_key

DEDUP_ORDER_ORDERS = ["order_ts_utc", "_ingested_at"]
DEDUP_ORDER_CLICKS = ["ts_utc", "_ingested_at"]


def orders(bronze: DataFrame, run_ts=None, dedup: bool = False,
           tolerant: bool = False) -> DataFrame:
    """bronze.orders -> silver.orders rows.

    dedup=False, tolerant=False: the staging job the runner uses: renames,
        lower(trim(status)), typed NULL currency, order time = first of
        (created_at, updated_at).
    tolerant=True: any of the source columns may be absent (they become
        typed NULLs); order time = first of (order_date, order_ts,
        created_at, updated_at); customer_id/amount are read as named.
    dedup=True: keep the latest row per order_id (order time, then
        _ingested_at, NULLs last).
    """
    if tolerant:
        def t(name):
            return to_utc_ntz(bronze, name) if name in bronze.columns else typed_null("timestamp_ntz")
        df = bronze.select(
            col_or_null(bronze, "order_id", "bigint").alias("order_id"),
            col_or_null(bronze, "customer_id", "bigint").alias("customer_id"),
            norm_lower(col_or_null(bronze, "status", "string")).alias("status"),
            col_or_null(bronze, "amount", "decimal(18,2)").alias("amount"),
            col_or_null(bronze, "currency", "string").alias("currency"),
            first_time(t("order_date"), t("order_ts"), t("created_at"), t("updated_at"))
                .alias("order_ts_utc"),
            t("_ingested_at").alias("_ingested_at"),
            load_stamp(run_ts).alias("_processed_at"))
    else:
        df = bronze.select(
            F.col("order_id"),
            F.col("user_id").alias("customer_id"),
            norm_lower("status").alias("status"),
            F.col("total_amount").alias("amount"),
            typed_null("string").alias("currency"),
            first_time(to_utc_ntz(bronze, "created_at"),
                       to_utc_ntz(bronze, "updated_at")).alias("order_ts_utc"),
            F.col("_ingested_at"),
            load_stamp(run_ts).alias("_processed_at"))
    if dedup:
        df = latest_per_key(df, ["order_id"], DEDUP_ORDER_ORDERS)
    return C.conform(df, C.SILVER_ORDERS)


def clicks(bronze: DataFrame, run_ts=None, null_keys: str = "keep", dedup: bool = True) -> DataFrame:
    """bronze.click_events -> silver.click_events rows: keep the latest
    delivery per event_id (by ts, then _ingested_at, NULLs last), then
    normalise text and paths and extract the metadata attributes.

    Only the key and the ordering columns are needed to pick the survivor,
    so cleaning and JSON parsing run after the de-duplication, on survivors
    only, and the shuffle carries the narrower bronze rows.  ``dedup=False``
    keeps every row (unkeyed rows have nothing to be de-duplicated by).
    """
    cols = ["event_id", "user_id", "session_id", "event_type", "page", "route",
            "element", "metadata_json", "_ingested_at"]
    keyed = bronze.select(*cols, to_utc_ntz(bronze, "ts").alias("ts_utc"))
    latest = latest_per_key(keyed, ["event_id"], DEDUP_ORDER_CLICKS, null_keys=null_keys) if dedup else keyed
    out = with_json_fields(latest, "metadata_json").select(
        "event_id", "user_id", "session_id",
        norm_lower("event_type").alias("event_type"),
        collapse_slashes("page").alias("page_path"),
        collapse_slashes("route").alias("route_path"),
        "element", "ts_utc",
        *METADATA_PATHS,
        "metadata_json", "_ingested_at",
        load_stamp(run_ts).alias("_processed_at"))
    return C.conform(out, C.SILVER_CLICKS)
