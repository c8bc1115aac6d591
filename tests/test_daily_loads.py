"""The daily mart from loads of orders, re-deliveries included."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from tierflow.plans import runner
from tierflow.session import scratch_path
from tierflow.sources.layers import LayerStore

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("order_id long, user_id long, status string, total_amount decimal(12,2), created_at timestamp_ntz, "
          "updated_at timestamp_ntz, _ingested_at timestamp_ntz")


def load(spark, rows):
    """Orders of (id, day or None, amount or None) rows."""
    return spark.createDataFrame(
        [(i, 1, "ok", None if a is None else Decimal(a), None if d is None else T0 + dt.timedelta(days=d, hours=5), T0, T0)
         for i, d, a in rows], SCHEMA)


def brute(rows):
    ids, revenue = defaultdict(set), defaultdict(lambda: None)
    for i, d, a in rows:
        ids[d] |= set() if i is None else {i}
        if a is not None:
            revenue[d] = (revenue[d] or 0) + a
    return {None if d is None else (T0 + dt.timedelta(days=d)).date(): (len(x), revenue[d]) for d, x in ids.items()}


def mart(store):
    return {r["order_date"]: (r["orders"], None if r["revenue"] is None else int(r["revenue"]))
            for r in store.read("gold", "orders_daily_revenue").collect()}


def test_loads_equal_a_count_distinct(spark):
    rng = random.Random(1)
    store, every = LayerStore(spark, scratch_path(spark, "t-daily")), []
    ids = [None, 0, -1, -40_000, 1, 32_768, 32_769, 10 ** 12, *range(100, 130)]
    for step in range(4):
        rows = [(rng.choice(ids), rng.choice([None, 0, 1, 2, step + 3]), rng.choice([None, 5, 70])) for _ in range(80)]
        every += rows
        days = runner.add_orders(store, load(spark, rows), f"load {step}")
        assert days == len({d for _, d, _ in rows}) and mart(store) == brute(every)
        assert runner.add_orders(store, load(spark, rows), f"load {step}") == 0 and mart(store) == brute(every)
    assert runner.add_orders(store, load(spark, []), "empty") == 0 and mart(store) == brute(every)


def test_a_load_reads_only_its_days(spark, monkeypatch):
    store = LayerStore(spark, scratch_path(spark, "t-daily-days"))
    runner.add_orders(store, load(spark, [(i, i % 10, 1) for i in range(100)]))
    seen = []
    whole = runner.gold.daily_from_state
    monkeypatch.setattr(runner.gold, "daily_from_state", lambda s: seen.append(s) or whole(s))
    assert runner.add_orders(store, load(spark, [(5, 5, 2), (5, 5, 2), (777, 7, 2)])) == 2
    assert {r[0].day for r in seen[0].select("order_date").distinct().collect()} == {6, 8}
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "state_month#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    got = mart(store)
    assert got[dt.date(2024, 1, 6)] == (10, 14) and got[dt.date(2024, 1, 8)] == (11, 12)
    assert got[dt.date(2024, 1, 1)] == (10, 10)


def test_a_stop_before_the_mart_is_made_good(spark, monkeypatch):
    store = LayerStore(spark, scratch_path(spark, "t-daily-stop"))
    runner.add_orders(store, load(spark, [(1, 0, 1)]), "a")
    with monkeypatch.context() as m:
        m.setattr(store, "overwrite", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runner.add_orders(store, load(spark, [(1, 0, 1), (2, 1, 1)]), "b")
    again = LayerStore(spark, store.root)
    runner.add_orders(again, load(spark, [(1, 0, 1), (2, 1, 1)]), "b")
    assert mart(again) == brute([(1, 0, 1), (1, 0, 1), (2, 1, 1)])
