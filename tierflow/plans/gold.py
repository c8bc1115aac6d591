"""Gold: star-schema dimension, facts and the daily revenue mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.functions.clean import (business_key, date_key, norm_lower,
                                      placeholder_count, to_day, to_utc_ntz)

FACT_CLICK_KEYS = ["session_id", "user_id", "page", "event_type", "event_date_key"]


def prepare_clicks(silver_clicks: DataFrame) -> DataFrame:
    """silver clicks as the facts read them (page_path -> page).

    event_type is already lower(trim()) in silver; cleaning it again would
    change nothing, so it is cleaned in one place only.
    """
    return silver_clicks.select(
        "event_id", "user_id", "session_id",
        F.col("page_path").alias("page"),
        "event_type",
        to_utc_ntz(silver_clicks, "ts_utc").alias("ts_utc"))


def prepare_orders(orders: DataFrame, source: str = "bronze") -> DataFrame:
    """Orders as the gold job reads them.

    source="bronze" (parity): bronze.orders, order time = created_at only.
    source="silver": silver.orders, order time = order_ts_utc.
    """
    if source == "silver":
        return orders.select("order_id", F.col("customer_id").alias("user_id"),
                             norm_lower("status").alias("status"),
                             F.col("amount").cast("decimal(12,2)").alias("total_amount"),
                             F.col("order_ts_utc").alias("order_ts"))
    return orders.select("order_id", "user_id", norm_lower("status").alias("status"),
                         "total_amount", to_utc_ntz(orders, "created_at").alias("order_ts"))


def dim_user(clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """Every non-NULL user id seen in clicks or orders, once.

    Plan: each side is partially de-duplicated map-side, then one shuffle
    on user_id.
    """
    ids = (clicks.select("user_id").where(F.col("user_id").isNotNull())
           .unionByName(orders.select("user_id").where(F.col("user_id").isNotNull()))
           .distinct())
    return C.conform(ids.withColumn("user_key", business_key("user_id")), C.DIM_USER)


def fact_orders(orders: DataFrame) -> DataFrame:
    """One row per order row: a narrow projection, no shuffle."""
    return C.conform(orders.select(
        "order_id", "user_id",
        placeholder_count("total_amount").alias("product_count"),
        "total_amount",
        date_key("order_ts").alias("order_date_key"),
        "status"), C.FACT_ORDERS)


def fact_clicks(clicks: DataFrame, unique_events: bool = False) -> DataFrame:
    """Distinct events per (session, user, page, event type, day).

    Groups with NULL keys are kept; NULL event ids are not counted.

    unique_events=True states that event_id is already unique in ``clicks``
    (true for silver.click_events, whose key is event_id): the distinct
    count is then a plain non-NULL count, planned as a single partial +
    final hash aggregate (one shuffle) instead of the two-level distinct
    aggregate (two shuffles).  Results are identical.
    """
    keyed = clicks.withColumn("event_date_key", date_key("ts_utc"))
    agg = (F.count("event_id") if unique_events else F.count_distinct("event_id"))
    return C.conform(keyed.groupBy(*FACT_CLICK_KEYS).agg(agg.alias("events_count")),
                     C.FACT_CLICKS)


def orders_daily_revenue(orders: DataFrame, sort: bool = False,
                         unique_orders: bool = False) -> DataFrame:
    """Distinct orders and revenue per order day (a NULL day is a group).

    unique_orders=True states that order_id is the key of ``orders`` (true
    for bronze.orders and silver.orders): the distinct count becomes a
    non-NULL count and the plan one partial + final hash aggregate.

    Stored tables have no order, so the sort is applied when a report reads
    the mart (``sort=True`` or ``report_daily_revenue``).
    """
    n = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    out = (orders.withColumn("order_date", to_day("order_ts"))
           .groupBy("order_date")
           .agg(n.alias("orders"),
                F.sum("total_amount").alias("revenue")))
    out = C.conform(out, C.ORDERS_DAILY_REVENUE)
    return out.orderBy("order_date") if sort else out


def daily_state(orders: DataFrame) -> DataFrame:
    """What one load of orders adds to the daily mart, in a form that merges:
    per order day and block of 32,768 order ids, the ids seen as a bitmap, and
    the revenue.  Ids that ascend with time fill few blocks a day."""
    rows = orders.select(to_day("order_ts").alias("order_date"), "total_amount",
                         F.bitmap_bucket_number("order_id").alias("id_block"),
                         F.bitmap_bit_position("order_id").alias("__bit"))
    return C.conform(rows.groupBy("order_date", "id_block").agg(
        F.bitmap_construct_agg("__bit").alias("ids"), F.sum("total_amount").alias("revenue")), C.ORDERS_DAILY_STATE)


def daily_from_state(state: DataFrame) -> DataFrame:
    """The daily mart of any number of loads: ids are united before they are
    counted, so an order delivered again counts once on its day, exactly; its
    revenue is added each time, as in ``orders_daily_revenue``."""
    blocks = state.groupBy("order_date", "id_block").agg(
        F.bitmap_or_agg("ids").alias("ids"), F.sum("revenue").alias("revenue"))
    counted = F.when(F.col("id_block").isNotNull(), F.bitmap_count("ids")).otherwise(F.lit(0))
    return C.conform(blocks.groupBy("order_date").agg(F.sum(counted).alias("orders"), F.sum("revenue").alias("revenue")),
                     C.ORDERS_DAILY_REVENUE)
