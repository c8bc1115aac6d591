"""Layer store versions and a whole pipeline run, run twice."""

import pytest

from tierflow.plans import bronze, quality, runner
from tierflow.session import scratch_path
from tierflow.sources import testdata as td
from tierflow.sources.layers import LayerStore

from tests.conftest import SF001


def test_missing_table_reads_empty_with_contract(spark):
    store = LayerStore(spark, scratch_path(spark, "t-empty"))
    df = store.read("silver", "orders")
    assert df.count() == 0 and "order_ts_utc" in df.columns


def test_vacuum_keeps_newest_versions(spark):
    store = LayerStore(spark, scratch_path(spark, "t-vacuum"))
    for n in (5, 4, 3):
        store.overwrite(spark.range(n).selectExpr("id AS user_id", "CAST(id AS STRING) AS user_key"),
                        "gold", "dim_user")
    assert store.vacuum("gold", "dim_user", keep=1) == [1, 2]
    assert store.read("gold", "dim_user").count() == 3
    assert not store._exists(store._version_path("gold", "dim_user", 1))


def test_overwrite_while_reading(spark):
    store = LayerStore(spark, scratch_path(spark, "t-ver"))
    store.overwrite(spark.range(5).withColumnRenamed("id", "user_id")
                    .selectExpr("user_id", "cast(user_id as string) user_key"), "gold", "dim_user")
    cur = store.read("gold", "dim_user")
    store.overwrite(cur.where("user_id < 3"), "gold", "dim_user")   # reads v1, writes v2
    assert store.current_version("gold", "dim_user") == 2
    assert store.read("gold", "dim_user").count() == 3


def test_pipeline_rerun_is_stable(spark):
    store = LayerStore(spark, scratch_path(spark, "t-run"))
    args = (td.raw_clicks(spark, SF001), td.oltp_orders(spark, SF001))
    c1 = runner.run(store, *args, with_orders=True, run_ts=td.RUN_TS)
    gold1 = sorted((tuple(r) for r in store.read("gold", "fact_clicks").collect()), key=repr)
    # a re-delivery of the same raw data: bronze grows, silver/gold do not change
    c2 = runner.run(store, args[0], None, with_orders=True, run_ts=td.RUN_TS)
    assert c2["bronze.click_events"] == c1["bronze.click_events"]
    assert c2["silver.click_events"] == c1["silver.click_events"]
    assert sorted((tuple(r) for r in store.read("gold", "fact_clicks").collect()), key=repr) == gold1
    rep = {(r.layer, r.table): r for r in quality.contract_report(store).collect()}
    assert all(r.schema_ok and r.duplicate_keys == 0 for r in rep.values())
    assert rep[("silver", "click_events")].null_keys == 0
    audit = {(r.layer, r.table): r.value for r in quality.audit(store).collect()}
    assert audit[("bronze", "click_events")] == 2 * c1["bronze.click_events"]
    scanned = {(r.layer, r.table): r.value for r in quality.audit(store, scan=True).collect()}
    assert scanned == audit


def test_with_orders_needs_input(spark):
    store = LayerStore(spark, scratch_path(spark, "t-noorders"))
    with pytest.raises(FileNotFoundError):
        runner.run(store, td.raw_clicks(spark, SF001), None, with_orders=True)


def test_incremental_runs_equal_full_recompute(spark):
    first = td.raw_clicks(spark, SF001, "first")
    second = td.raw_clicks(spark, SF001, "second")
    inc = LayerStore(spark, scratch_path(spark, "t-inc"))
    runner.run(inc, second, run_ts=td.RUN_TS)                 # newer deliveries first
    runner.run(inc, first, run_ts=td.RUN_TS)                  # older ones arrive late
    assert inc.source_seq("silver", "click_events") == 2
    full = LayerStore(spark, scratch_path(spark, "t-full"))
    runner.run(full, first.unionByName(second), run_ts=td.RUN_TS, incremental=False)
    for table in ("click_events",):
        a, b = inc.read("silver", table), full.read("silver", table)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a, b = inc.read("gold", "fact_clicks"), full.read("gold", "fact_clicks")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # the second incremental run staged only the second load
    plan = inc.read_loads_after("bronze", "click_events", 1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_seq" in plan


def stopped(*args, **kw):
    raise OSError("stopped")


def test_stopped_append_is_not_seen_and_written_anew(spark, monkeypatch):
    store = LayerStore(spark, scratch_path(spark, "t-stop"))
    first, second = (bronze.clicks(td.raw_clicks(spark, SF001, x), td.RUN_TS) for x in ("first", "second"))
    n = store.append(first, "bronze", "click_events")
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", stopped)
        with pytest.raises(OSError):
            store.append(second, "bronze", "click_events")
    assert store.read("bronze", "click_events").count() == n
    n += store.append(second, "bronze", "click_events")
    assert store.read("bronze", "click_events").count() == n
    for scan in (True, False):
        assert quality.audit(store, scan=scan).first().value == n
    with pytest.raises(ValueError):
        store.append(first, "silver", "orders")


def test_gold_follows_silver_after_a_stop(spark, monkeypatch):
    store = LayerStore(spark, scratch_path(spark, "t-follow"))
    first, second = (td.raw_clicks(spark, SF001, x) for x in ("first", "second"))
    runner.run(store, first, run_ts=td.RUN_TS, load_id="a")
    with monkeypatch.context() as m:
        m.setattr(runner, "refresh_fact_clicks", stopped)
        with pytest.raises(OSError):
            runner.run(store, second, run_ts=td.RUN_TS, load_id="b")
    # the run is repeated: its clicks are not loaded again, and gold catches up
    counts = runner.run(store, second, run_ts=td.RUN_TS, load_id="b")
    assert counts["bronze.click_events"] == 0
    assert store.read("bronze", "click_events").count() == first.count() + second.count()
    assert store.read("silver", "click_events_rejected").count() == 1
    silver = store.read("silver", "click_events")
    total = store.read("gold", "fact_clicks").selectExpr("sum(events_count)").first()[0]
    assert total == silver.count()
    assert store.source_seq("gold", "fact_clicks") == store.last_commit("silver", "click_events")


def test_views_and_ddl(spark):
    from tierflow import contracts as C
    store = LayerStore(spark, scratch_path(spark, "t-views"))
    store.overwrite(td.items(spark, SF001), "app", "inventory_items")
    assert "app_inventory_items" in store.register_views()
    assert spark.sql("SELECT count(*) FROM app_inventory_items").first()[0] == 200
    text = C.ddl("gold", "fact_clicks", "/lake/gold/fact_clicks")
    assert "PARTITIONED BY (event_month)" in text and "events_count BIGINT" in text
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.sql(C.ddl("gold", "fact_clicks", scratch_path(spark, "t-ddl")))
    assert "events_count" in spark.table("gold.fact_clicks").columns


def test_command_line_run(spark, capsys):
    from tierflow.__main__ import main
    root = scratch_path(spark, "t-cli")
    td.raw_clicks(spark, SF001).drop("_ingested_at").write.json(f"{root}/landing")
    td.oltp_orders(spark, SF001).write.parquet(f"{root}/orders")
    counts = main(["--lake", f"{root}/lake", "--clicks", f"{root}/landing/*.json",
                   "--orders-parquet", f"{root}/orders", "--with-orders"], spark=spark)
    assert counts["silver.orders"] == 1500 and counts["bronze.click_events"] == 1200
    out = capsys.readouterr().out
    assert "rows_written" in out and "orders_daily_revenue" in out


def test_contract_report_sees_stored_types(spark):
    from pyspark.sql import functions as F
    store = LayerStore(spark, scratch_path(spark, "t-contract"))
    good = td.items(spark, SF001)
    store.overwrite(good, "app", "inventory_items")
    rep = quality.contract_report(store).first()
    assert rep.schema_ok and rep.duplicate_keys == 0 and rep.rows == 200
    # a writer that stored quantity as bigint breaks the contract
    bad = good.withColumn("quantity", F.col("quantity").cast("bigint"))
    store._write(bad, store._version_path("app", "inventory_items", 2), "overwrite", [], [])
    store._commit("app", "inventory_items", 2, 200)
    assert not quality.contract_report(store).first().schema_ok
    assert dict(store.read("app", "inventory_items").dtypes)["quantity"] == "int"


def test_runs_keep_few_versions(spark):
    import os
    store = LayerStore(spark, scratch_path(spark, "t-keep"))
    for _ in range(3):
        runner.run(store, td.raw_clicks(spark, SF001, "second"), td.oltp_orders(spark, SF001),
                   run_ts=td.RUN_TS, keep_versions=2)
    folder = store.table_path("gold", "dim_user").replace("file:", "")
    versions = sorted(d for d in os.listdir(folder) if d.startswith("v"))
    assert versions == ["v000002", "v000003"]
    assert store.read("gold", "dim_user").count() > 0


def test_commit_log_compaction(spark):
    store = LayerStore(spark, scratch_path(spark, "t-compact"))
    frame = spark.range(3).selectExpr("id AS user_id", "CAST(id AS STRING) AS user_key")
    for _ in range(4):
        store.overwrite(frame, "gold", "dim_user")
    before = (store.current_version("gold", "dim_user"), store._rows("gold", "dim_user"))
    store.refresh()
    assert store.compact_log("gold", "dim_user") == 4
    store.overwrite(frame.limit(2), "gold", "dim_user")     # commits continue after a snapshot
    fresh = LayerStore(spark, store.root)
    assert before == (4, 3)
    assert (fresh.current_version("gold", "dim_user"), fresh._rows("gold", "dim_user")) == (5, 2)
    assert fresh.log("gold", "dim_user").count() == 5
    audit = {(r.layer, r.table): r.value for r in quality.audit(fresh).collect()}
    assert audit[("gold", "dim_user")] == 2


def test_vacuum_compacts_long_logs(spark):
    import os
    store = LayerStore(spark, scratch_path(spark, "t-autocompact"))
    frame = spark.range(2).selectExpr("id AS user_id", "CAST(id AS STRING) AS user_key")
    for _ in range(22):
        store.overwrite(frame, "gold", "dim_user")
    store.vacuum("gold", "dim_user", keep=1)
    root = store.table_path("gold", "dim_user").replace("file:", "")
    assert os.listdir(f"{root}/_logsnap") == ["s00000022"]
    assert not [n for n in os.listdir(f"{root}/_log") if n.endswith(".parquet")]
    fresh = LayerStore(spark, store.root)
    assert (fresh.current_version("gold", "dim_user"), fresh._rows("gold", "dim_user")) == (22, 2)
