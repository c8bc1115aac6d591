"""Reconciliation of deliveries with the tables built from them."""

import pytest
from pyspark.sql import functions as F

from tierflow.plans import quality, runner
from tierflow.session import scratch_path
from tierflow.sources import testdata as td
from tierflow.sources.layers import LayerStore

from tests.conftest import SF001

FAULTS = ("lost", "doubled", "foreign", "stale", "unkeyed")


@pytest.fixture(scope="module")
def lake(spark):
    store = LayerStore(spark, scratch_path(spark, "t-reconcile"))
    for part in ("first", "second"):
        runner.run(store, td.raw_clicks(spark, SF001, part), td.oltp_orders(spark, SF001), run_ts=td.RUN_TS)
    return store


class Tampered:
    """A store one table of which reads otherwise."""
    def __init__(self, store, table, change):
        self.store, self.table, self.change = store, table, change

    def read(self, layer, table):
        df = self.store.read(layer, table)
        return self.change(df) if table == self.table and layer == "silver" else df


def report(store):
    return {r.part: (r.rows, r.checksum) for r in quality.reconcile_clicks(store).collect()}


def faults(store):
    return {k: v[0] for k, v in report(store).items() if k in FAULTS and v[0]}


def test_a_run_balances(lake):
    got = report(lake)
    assert not faults(lake)
    for i in (0, 1):
        assert got["raw"][i] == got["stored"][i] + got["superseded"][i] + got["rejected"][i]
    assert got["raw"][0] == lake.read("bronze", "click_events").count() and got["rejected"][0] > 0


def one(df):
    return F.col("event_id") == df.agg(F.min("event_id")).first()[0]


@pytest.mark.parametrize("change,fault", [
    (lambda df: df.where(~one(df)), {"lost": 1}),
    (lambda df: df.unionByName(df.where(one(df))), {"doubled": 1, "foreign": 1}),
    (lambda df: df.withColumn("browser", F.when(one(df), "other").otherwise(F.col("browser"))), {"foreign": 1}),
    (lambda df: df.withColumn("event_id", F.when(one(df), "e-none").otherwise(F.col("event_id"))),
     {"lost": 1, "foreign": 1, "stale": 1}),
])
def test_a_tampered_row_is_found(lake, change, fault):
    assert faults(Tampered(lake, "click_events", change)) == fault


def test_a_stale_row_is_found(lake, spark):
    from tierflow.plans import silver
    raw = silver.clicks(lake.read("bronze", "click_events"), td.RUN_TS, dedup=False)
    again = raw.where(F.col("ts_utc").isNotNull()).groupBy("event_id").agg(F.countDistinct("ts_utc").alias("n"),
                                                                          F.min("ts_utc").alias("ts_utc")).where("n > 1")
    victim = again.orderBy("event_id").first()
    earlier = raw.where((F.col("event_id") == victim.event_id) & (F.col("ts_utc") == F.lit(victim.ts_utc)))
    swap = lambda df: df.where(F.col("event_id") != victim.event_id).unionByName(earlier)      # noqa: E731
    assert faults(Tampered(lake, "click_events", swap)) == {"stale": 1}


@pytest.mark.parametrize("change", [lambda df: df.limit(0), lambda df: df.unionByName(df)])
def test_rejected_rows_are_counted(lake, change):
    n = lake.read("silver", "click_events_rejected").count()
    assert faults(Tampered(lake, "click_events_rejected", change)) == {"unkeyed": n}


def test_empty_tables(spark):
    assert set(report(LayerStore(spark, scratch_path(spark, "t-reconcile-none"))).values()) <= {(0, 0), (0, None)}
