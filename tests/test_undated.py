"""Silver clicks without a time: kept by ingest day and key part, so that a
load never rewrites the undated rows of earlier days."""

import datetime as dt

from tests.test_partition_upsert import clicks, mtimes
from tierflow import contracts as C
from tierflow.operators.dedup import latest_per_key
from tierflow.session import scratch_path
from tierflow.sources.layers import LayerStore
from pyspark.sql import functions as F

T = dt.datetime
ORDER = ["ts_utc", "_ingested_at"]


def load(spark, rows, day):
    """(event_id, ts, device) rows delivered on a day of March."""
    at = F.lit(None if day is None else T(2024, 3, day, 6)).cast("timestamp_ntz")
    return clicks(spark, rows).withColumn("_ingested_at", at)


def stored(store):
    return sorted((r.event_id, r.ts_utc, r.device) for r in store.read("silver", "click_events").collect())


def test_undated_load_rewrites_no_older_undated_rows(spark):
    store = LayerStore(spark, scratch_path(spark, "t-undated"))
    first = [(f"k{i}", None, "first") for i in range(200)] + [("dated", T(2024, 1, 1, 5), "first")]
    store.upsert(load(spark, first, 1), "silver", "click_events", prefer_latest=ORDER)
    vpath = store._version_path("silver", "click_events", 1).replace("file:", "")
    before = mtimes(vpath)
    assert len({f.rsplit("/", 1)[0] for f in before if "_undated=2024-03-01" in f}) == C.UNDATED_PARTS

    second = [(f"n{i}", None, "second") for i in range(200)] + [("dated2", T(2024, 1, 2, 5), "second")]
    res = store.upsert(load(spark, second, 2), "silver", "click_events", prefer_latest=ORDER)
    after = mtimes(vpath)
    assert {k: after.get(k) for k in before} == before            # nothing older was touched
    assert all(d["_event_date"] is not None or d["_undated"].startswith("2024-03-02.") for d in res.touched)
    assert res.delta == 201
    assert stored(store) == sorted([(a, b, c) for a, b, c in first + second], key=lambda r: r[0])


def test_undated_rows_move_and_leave_empty_parts(spark):
    store = LayerStore(spark, scratch_path(spark, "t-undated-move"))
    one = load(spark, [("a", None, "1"), ("b", None, "1"), ("c", T(2024, 1, 1, 5), "1")], 1)
    two = load(spark, [("a", T(2024, 1, 3, 5), "2"),              # dated now: leaves its part
                       ("b", None, "2"),                          # moves to the part of its new ingest day
                       ("c", None, "2")], 2)                      # a NULL time is older than any: c stays
    unstamped = load(spark, [("d", None, "3"), ("b", None, "3")], None)
    for part in (one, two, unstamped):
        store.upsert(part, "silver", "click_events", prefer_latest=ORDER)
    want = latest_per_key(one.unionByName(two).unionByName(unstamped), ["event_id"], ORDER)
    key = lambda r: r.event_id
    got = store.read("silver", "click_events")
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert stored(store) == [("a", T(2024, 1, 3, 5), "2"), ("b", None, "2"), ("c", T(2024, 1, 1, 5), "1"),
                             ("d", None, "3")]
    raw = store.read("silver", "click_events", raw=True)
    places = {r.event_id: r["_undated"][:-3] or "-" for r in raw.collect()}
    assert places == {"a": "-", "b": "2024-03-02", "c": "-", "d": "none"}
    files = [f for f in mtimes(store._version_path("silver", "click_events", 1).replace("file:", ""))]
    assert not [f for f in files if "_undated=2024-03-01" in f]   # both have left


def test_several_columns_prune_folders(spark):
    store = LayerStore(spark, scratch_path(spark, "t-undated-prune"))
    rows = [(f"k{i}", None, "x") for i in range(50)] + [("e", T(2024, 1, 1, 5), "x")]
    store.upsert(load(spark, rows, 1), "silver", "click_events")
    raw = store.read("silver", "click_events", raw=True)
    part = raw.where("event_id = 'k7'").select("_event_date", "_undated").first().asDict()
    some = raw.where(store._any_match([part], ["_event_date", "_undated"]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("FileScan")[0]              # decided on folders alone, no row is tested
    assert 0 < some.count() < 50
    both = [{"_event_date": dt.date(2024, 1, 1), "_undated": "-"}, part]
    assert raw.where(store._any_match(both, ["_event_date", "_undated"])).count() == some.count() + 1
