"""Gold jobs (L6-L9) on literal frames, incl. NULL groups."""

import datetime as dt
from decimal import Decimal

from tierflow.plans import gold

T = dt.datetime
CLICKS = "event_id string, user_id bigint, session_id string, page string, event_type string, ts_utc timestamp_ntz"
ORDERS = "order_id bigint, user_id bigint, status string, total_amount decimal(12,2), order_ts timestamp_ntz"


def test_dim_user(spark):
    c = spark.createDataFrame([("e1", 1, "s", "/", "click", T(2024, 1, 1)),
                               ("e2", 2, "s", "/", "click", T(2024, 1, 1)),
                               ("e3", None, "s", "/", "click", T(2024, 1, 1))], CLICKS)
    o = spark.createDataFrame([(1, 2, "f", Decimal("1.00"), None), (2, 3, "f", None, None),
                               (3, None, "f", None, None)], ORDERS)
    out = sorted(tuple(r) for r in gold.dim_user(c, o).collect())
    assert out == [(1, "1"), (2, "2"), (3, "3")]


def test_fact_clicks_null_groups_and_distinct(spark):
    c = spark.createDataFrame([
        ("e1", None, "s", "/", "click", T(2024, 1, 1, 5)),
        ("e2", None, "s", "/", "click", T(2024, 1, 1, 6)),
        ("e2", None, "s", "/", "click", T(2024, 1, 1, 6)),   # same event twice
        ("e3", 1, "s", "/", "click", None),                  # NULL date group kept
        (None, 1, "s", "/", "click", None),                  # NULL id not counted
    ], CLICKS)
    out = sorted((r.user_id or -1, r.event_date_key or -1, r.events_count)
                 for r in gold.fact_clicks(c).collect())
    assert out == [(-1, 20240101, 2), (1, -1, 1)]


def test_fact_orders_and_daily(spark):
    o = spark.createDataFrame([
        (1, 1, "f", Decimal("10.50"), T(2024, 1, 1, 10)),
        (2, 1, "o", None, T(2024, 1, 1, 11)),
        (3, 2, "p", Decimal("2.25"), None),
    ], ORDERS)
    fo = {r.order_id: r for r in gold.fact_orders(o).collect()}
    assert (fo[1].product_count, fo[1].order_date_key) == (1, 20240101)
    assert fo[2].product_count is None and fo[3].order_date_key is None
    for uniq in (False, True):
        daily = {r.order_date: (r.orders, r.revenue)
                 for r in gold.orders_daily_revenue(o, unique_orders=uniq).collect()}
        assert daily == {dt.date(2024, 1, 1): (2, Decimal("10.50")), None: (1, Decimal("2.25"))}
        assert sum(v[1] for v in daily.values()) == Decimal("12.75")   # sum(revenue) = sum(amount)


def test_prepare_orders_from_silver(spark):
    s = spark.createDataFrame(
        [(1, 5, "paid", Decimal("3.10"), None, T(2024, 1, 2), T(2024, 1, 3), T(2025, 1, 1))],
        "order_id bigint, customer_id bigint, status string, amount decimal(18,2), currency string, "
        "order_ts_utc timestamp_ntz, _ingested_at timestamp_ntz, _processed_at timestamp_ntz")
    o = gold.prepare_orders(s, source="silver")
    r = gold.fact_orders(o).first()
    assert (r.user_id, r.total_amount, r.order_date_key) == (5, Decimal("3.10"), 20240102)
