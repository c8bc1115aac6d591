"""Feeds of several shapes, open metadata, and the catalog."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.functions import variant
from tierflow.plans import registry, silver
from tierflow.session import scratch_path
from tierflow.sources import shapes
from tierflow.sources.layers import LayerStore

from tests.conftest import SF001


def lines(spark, *text):
    path = scratch_path(spark, "t-shapes")
    spark.createDataFrame([(t,) for t in text], "value string").write.text(path)
    return path


def test_lines_of_any_shape(spark):
    path = lines(
        spark, '{"order_id": 1, "amount": 12.5, "created_at": "2024-01-02T03:04:05Z"}',
        '{"order_id": "2", "amount": "7", "customer_id": "8.0", "order_date": "2024-02-03"}',
        '{"order_id": 3.5, "amount": "n/a", "customer_id": {"id": 1}, "order_date": "x", "other": [1]}',
        '{"order_id": null, "currency": 5}', "no json", "")
    got = {r.order_id if r._malformed is None else "bad": r for r in
           shapes.read_lines(spark, path, C.ORDERS_FEED, {"currency": "USD"}).collect()
           if r.order_id is not None or r._conflicts or r._malformed}
    assert got[1].amount == Decimal("12.50") and got[1].created_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1].currency == "USD" and got[1]._conflicts == []
    assert got[2].customer_id == 8 and got[2].order_date == dt.datetime(2024, 2, 3)
    assert sorted(got[None]._conflicts) == ["amount", "customer_id", "order_date", "order_id"]
    assert got["bad"]._malformed == "no json"
    assert shapes.read_lines(spark, path, C.ORDERS_FEED).where("currency = '5'").count() == 1


def test_typed_files_are_one_feed(spark):
    a = spark.createDataFrame([(1, 2.0, dt.date(2024, 1, 1))], "order_id int, customer_id double, order_date date")
    b = spark.createDataFrame([("7", "x", 20240101)], "order_id string, amount string, order_date long")
    got = {r.order_id: r for r in shapes.union_shapes([a, b], C.ORDERS_FEED).collect()}
    assert got[1].customer_id == 2 and got[1].order_date == dt.datetime(2024, 1, 1) and got[1]._conflicts == []
    assert got[7].amount is None and sorted(got[7]._conflicts) == ["amount", "order_date"]
    none = shapes.align(spark.createDataFrame([(1,)], "other int"), C.ORDERS_FEED, {"status": "new"}).first()
    assert none.status == "new" and none.order_id is None and none._conflicts == []


def test_every_step_of_the_time_fallback(spark):
    path = lines(spark, *[f'{{"order_id": {i}, ' + ", ".join(f'"{c}": "2024-0{m}-01"' for m, c in steps) + "}"
                          for i, steps in enumerate([
                              [(1, "order_date"), (2, "order_ts"), (3, "created_at"), (4, "updated_at")],
                              [(2, "order_ts"), (3, "created_at"), (4, "updated_at")],
                              [(3, "created_at"), (4, "updated_at")], [(4, "updated_at")]])])
    out = silver.orders(shapes.read_lines(spark, path, C.ORDERS_FEED), tolerant=True)
    assert {r.order_id: r.order_ts_utc.month for r in out.collect()} == {0: 1, 1: 2, 2: 3, 3: 4}


def test_lines_are_scanned_once(spark):
    path = lines(spark, '{"order_id": 1}')
    plan = silver.orders(shapes.read_lines(spark, path, C.ORDERS_FEED), tolerant=True, dedup=True) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Python" not in plan


def test_variant_paths(spark):
    rows = ['{"a": 1, "b": {"c": [1, "x"], "d": null}}', '{"a": 2.5, "b": []}', '{"a": null}', "[1, 2]", "3", "no json", "", None]
    df = variant.with_variant(spark.createDataFrame([(t,) for t in rows], "metadata_json string"))
    got = df.select("metadata_json", variant.at("metadata", "$.b.c[1]").alias("x"),
                    variant.at("metadata", "$.a", "decimal(4,1)").alias("a")).collect()
    assert [(r.x, r.a) for r in got] == [("x", Decimal(1)), (None, Decimal("2.5"))] + [(None, None)] * 6
    report = {r.path: (r.rows, r.type) for r in variant.path_report(df, depth=3).collect()}
    assert report["$.a"][0] == 3 and report["$.a"][1].startswith("DECIMAL")
    assert report["$.b"] == (2, "VARIANT") and report["$.b.c[*]"] == (2, "VARIANT")
    assert report["$[*]"] == (2, "BIGINT") and report["$.b.d"] == (1, "VOID")
    assert variant.path_report(df.limit(0)).count() == 0
    assert set(variant.path_report(df, depth=1).select("path").toPandas()["path"]) == {"$.a", "$.b", "$[*]"}


def test_catalog_reads_committed_loads_and_follows_versions(spark):
    store = LayerStore(spark, scratch_path(spark, "t-catalog"))
    store.append(registry.bronze_clicks(spark, SF001), "bronze", "click_events")
    n = store.read("bronze", "click_events").count()
    # a load that was stopped before its commit
    stopped = registry.bronze_clicks(spark, SF001).limit(5).withColumn("_ingest_date", F.to_date("_ingested_at"))
    stopped.write.partitionBy("_ingest_date").parquet(f"{store._version_path('bronze', 'click_events', 1)}/_load_seq=2")
    store.overwrite(registry.gold_fact_orders(spark, SF001), "gold", "fact_orders")
    names = store.register_tables("t_catalog_")
    assert names == ["t_catalog_bronze.click_events", "t_catalog_gold.fact_orders"]
    assert spark.table(names[0]).count() == n
    facts = spark.table(names[1])
    assert facts.columns[:-1] == C.FACT_ORDERS.fieldNames()
    store.overwrite(store.read("gold", "fact_orders").limit(3), "gold", "fact_orders")
    store.register_tables("t_catalog_")
    assert spark.table(names[1]).count() == 3
    spark.sql("DROP DATABASE t_catalog_gold CASCADE")
    assert store.read("gold", "fact_orders").count() == 3          # external: the files stay
