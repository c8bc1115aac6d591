"""apply_changes (J3-J5) and dense_index."""

import datetime as dt

from pyspark.sql import functions as F

from tierflow.operators.changes import apply_changes, dense_index

T0 = dt.datetime(2025, 1, 1)
ITEMS = "id bigint, name string, sku string, quantity int, location string, updated_at timestamp_ntz"
CHG = "seq bigint, op string, id bigint, name string, sku string, quantity int, location string"


def test_change_resolution(spark):
    snap = spark.createDataFrame([(i, f"n{i}", f"s{i}", i, f"l{i}", T0) for i in range(1, 8)], ITEMS)
    ch = spark.createDataFrame([
        (1, "update", 1, "u1", "s", 5, "L", ),          # plain update
        (2, "update", 2, "a", "s", 1, "L"),             # two updates: later wins whole
        (3, "update", 2, "b", "s", 0, None),
        (4, "update", 3, "x", "s", 1, "L"),             # update then delete: gone
        (5, "delete", 3, None, None, None, None),
        (6, "delete", 4, None, None, None, None),       # delete then update: stays gone
        (7, "update", 4, "y", "s", 1, "L"),
        (8, "update", 99, "u", "s", 1, "L"),            # unknown id: nothing
        (9, "delete", 98, None, None, None, None),      # unknown id: nothing
        (10, "create", None, "c1", "s", 3, "W"),
        (11, "create", 5, "bad", "s", 3, "W"),          # create with id: rejected
        (12, "create", None, "c2", "s", 0, "W"),
    ], CHG)
    out = {r.id: r for r in apply_changes(snap, ch, run_ts="2025-02-01 00:00:00").collect()}
    stamp = dt.datetime(2025, 2, 1)
    assert set(out) == {1, 2, 5, 6, 7, 8, 9}
    assert (out[1].name, out[1].quantity, out[1].updated_at) == ("u1", 5, stamp)
    assert (out[2].name, out[2].quantity, out[2].location) == ("b", 0, None)
    assert out[5].name == "n5" and out[5].updated_at == T0
    assert (out[8].name, out[9].name) == ("c1", "c2")
    assert out[8].updated_at == stamp


def test_dense_index_many_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5000).alias("seq"))
    out = dense_index(df, ["seq"], "i").collect()
    assert sorted((r.seq, r.i) for r in out) == [(s, s + 1) for s in range(5000)]


def test_ids_are_never_reused_across_runs(spark):
    from tierflow.plans import runner
    from tierflow.session import scratch_path
    from tierflow.sources.layers import LayerStore
    store = LayerStore(spark, scratch_path(spark, "t-items"))
    snap = spark.createDataFrame([(i, f"n{i}", "s", i, "l", T0) for i in (1, 2, 3)], ITEMS)
    store.overwrite(snap, "app", "inventory_items")
    runner.apply_item_changes(store, spark.createDataFrame(
        [(1, "delete", 3, None, None, None, None)], CHG))            # frees the top id
    res = runner.apply_item_changes(store, spark.createDataFrame(
        [(2, "create", None, "c", "s", 1, "W"), (3, "create", 9, "bad", "s", 1, "W")], CHG))
    ids = sorted(r.id for r in store.read("app", "inventory_items").collect())
    assert ids == [1, 2, 4]                                          # 3 is not handed out again
    assert [r.reason for r in res["invalid_changes"].collect()] == ["create_with_id"]
    assert store._rows("app", "inventory_items") == 3
