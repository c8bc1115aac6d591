"""Upserts into a table stored in buckets of its key."""

import datetime as dt
import random
import re

import pytest

from tierflow import contracts as C
from tierflow.session import scratch_path
from tierflow.sources.layers import LayerStore

T0 = dt.datetime(2024, 1, 1)


def orders(spark, rows):
    """Orders of (order_id, status) rows."""
    return spark.createDataFrame([(i, 1, s, None, "EUR", T0, T0, T0) for i, s in rows],
                                 "order_id long, customer_id long, status string, amount decimal(18,2), currency string, "
                                 "order_ts_utc timestamp_ntz, _ingested_at timestamp_ntz, _processed_at timestamp_ntz")


def held(store):
    return {r["order_id"]: r["status"] for r in store.read("silver", "orders").collect()}


def test_upserts_equal_a_dict(spark):
    rng = random.Random(4)
    store, want = LayerStore(spark, scratch_path(spark, "t-buckets")), {}
    for step in range(4):
        rows = {rng.randint(-50, 300): rng.choice([None, "a", f"s{step}"]) for _ in range(120)}
        want |= rows
        done = store.upsert(orders(spark, rows.items()), "silver", "orders")
        assert held(store) == want and store._rows("silver", "orders") == len(want)
    assert done.touched is None
    assert store.read("silver", "orders").count() == len(want)
    # a new session knows nothing of the catalog: the buckets are found again
    again = LayerStore(spark, store.root)
    spark.sql(f"DROP TABLE {again._bucket_table(again._version_path('silver', 'orders', 4))}")
    again.upsert(orders(spark, [(1, "new")]), "silver", "orders")
    assert held(again) == want | {1: "new"}
    assert again.vacuum("silver", "orders", 1) == [1, 2, 3, 4] and held(again) == want | {1: "new"}


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_bad_keys_fail_and_leave_the_table(spark, rows):
    store = LayerStore(spark, scratch_path(spark, "t-buckets-bad"))
    store.overwrite(orders(spark, [(1, "x"), (2, "y")]), "silver", "orders")
    with pytest.raises(Exception, match="NULL or repeated key"):
        store.upsert(orders(spark, rows), "silver", "orders")
    assert held(LayerStore(spark, store.root)) == {1: "x", 2: "y"}


def test_stored_rows_are_not_exchanged(spark):
    store = LayerStore(spark, scratch_path(spark, "t-buckets-plan"))
    store.overwrite(orders(spark, [(i, "x") for i in range(500)]), "silver", "orders")
    plan = store.merged_buckets(orders(spark, [(3, "y")]), "silver", "orders")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Bucketed: true" in plan
    scan = plan.index("Bucketed: true")
    assert plan.rindex("Exchange") > scan or plan.index("Exchange") > plan.index("SortMergeJoin")
    n = C.BUCKETS["silver", "orders"]
    assert f"hashpartitioning(order_id" in plan and f", {n})" in plan
    files = store.read("silver", "orders").inputFiles()
    assert len(files) <= n


def test_a_version_without_buckets_is_taken_over(spark, monkeypatch):
    store = LayerStore(spark, scratch_path(spark, "t-buckets-old"))
    with monkeypatch.context() as m:
        m.setattr(C, "BUCKETS", {})
        store.overwrite(orders(spark, [(1, "x"), (2, "y")]), "silver", "orders")
    assert store.read_buckets("silver", "orders") is None
    store.upsert(orders(spark, [(2, "z")]), "silver", "orders")
    assert store.read_buckets("silver", "orders") is not None and held(store) == {1: "x", 2: "z"}
