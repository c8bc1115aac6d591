"""Physical-plan assertions: pushdown, pruning, shuffles, no Python."""

from tierflow.plans import registry
from tierflow.plans import gold

from tests.conftest import SF01


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_query_plan(spark):
    for name in ("silver_clicks", "gold_fact_clicks", "upsert_orders", "items_validity",
                 "gold_dim_user", "json_extract", "silver_orders_dedup"):
        p = plan(registry.QUERIES[name](spark, SF01))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_scan_prunes_columns(spark):
    p = plan(registry.gold_orders_daily_revenue(spark, SF01))
    assert "o_orderpriority" not in p          # only needed columns are read


def test_month_filter_prunes_partitions(spark):
    from tierflow.session import scratch_path
    from tierflow.sources.layers import LayerStore
    store = LayerStore(spark, scratch_path(spark, "t-prune"))
    store.overwrite(registry.gold_fact_orders(spark, SF01), "gold", "fact_orders")
    df = store.read("gold", "fact_orders", raw=True).where("order_month = 199501")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(order_month" in p and "(order_month" in p
    assert df.count() == df.where("order_date_key between 19950101 and 19950131").count()


def test_value_filter_pushed_to_parquet(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet").where("l_quantity > 45").select("l_partkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p


def test_fact_clicks_unique_events_single_shuffle(spark):
    # as stored silver is read back: a scan with no partitioning
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    clicks = ev.selectExpr("cast(event_id as string) event_id", "user_id",
                           "cast(user_id as string) session_id", "event_type as page",
                           "event_type", "ts as ts_utc")
    fast = plan(gold.fact_clicks(clicks, unique_events=True))
    slow = plan(gold.fact_clicks(clicks, unique_events=False))
    assert fast.count("Exchange hashpartitioning") < slow.count("Exchange hashpartitioning")


def test_silver_dedup_partial_limit(spark):
    p = plan(registry.silver_clicks(spark, SF01))
    assert "WindowGroupLimit" in p
