"""Item rules."""

from tierflow.operators.items import lookup, low_stock, validity

ITEMS = "id bigint, name string, sku string, quantity int, location string"
CHG = "seq bigint, op string, id bigint, name string, sku string, quantity int, location string"


def test_low_stock_edges(spark):
    df = spark.createDataFrame([(1, "a", "s", q, "l") for q in (0, 4, 5, None, -1)], ITEMS)
    assert [r.low_stock for r in low_stock(df).collect()] == [True, True, False, False, True]


def test_validity(spark):
    ch = spark.createDataFrame([
        (1, "create", None, "a", "s", 0, "l"),      # zero is valid
        (2, "create", 5, "a", "s", 1, "l"),
        (3, "update", None, "a", "s", 1, "l"),
        (4, "update", 1, "", "s", 1, "l"),
        (5, "update", 1, "a", "s", None, "l"),
        (6, "update", 1, "a", "s", -1, "l"),
        (7, "delete", 1, None, None, None, None),
        (8, "rename", 1, "a", "s", 1, "l"),
    ], CHG)
    got = {r.seq: (r.valid, r.reason) for r in validity(ch).collect()}
    assert got == {1: (True, None), 2: (False, "create_with_id"), 3: (False, "missing_id"),
                   4: (False, "missing_name"), 5: (False, "missing_quantity"),
                   6: (False, "negative_quantity"), 7: (True, None), 8: (False, "unknown_op")}


def test_lookup_is_semi_join(spark):
    items = spark.createDataFrame([(i, "n", "s", 1, "l") for i in range(5)], ITEMS)
    wanted = spark.createDataFrame([(1,), (1,), (3,), (42,)], "id bigint")
    assert sorted(r.id for r in lookup(items, wanted).collect()) == [1, 3]
