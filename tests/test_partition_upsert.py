"""LayerStore.upsert: only touched partitions are rewritten, moved rows
leave their old partition, and the result equals the frame-level upsert."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.operators.upsert import upsert
from tierflow.session import scratch_path
from tierflow.sources.layers import LayerStore

T = dt.datetime


def clicks(spark, rows):
    df = spark.createDataFrame(rows, "event_id string, ts_utc timestamp_ntz, device string")
    others = [f for f in C.SILVER_CLICKS.fields if f.name not in df.columns]
    return C.conform(df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others]),
                     C.SILVER_CLICKS)


def mtimes(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def test_partition_scoped_upsert(spark):
    store = LayerStore(spark, scratch_path(spark, "t-pupsert"))
    target = clicks(spark, [("a", T(2024, 1, 1, 5), "d1"), ("b", T(2024, 1, 2, 5), "d2"),
                            ("c", T(2024, 1, 4, 5), "d4"), ("d", None, "null-day")])
    store.upsert(target, "silver", "click_events")
    vpath = store._version_path("silver", "click_events", 1).replace("file:", "")
    untouched = {k: v for k, v in mtimes(vpath).items() if "_event_date=2024-01-04" in k}
    assert untouched

    source = clicks(spark, [("a", T(2024, 1, 3, 5), "moved"),     # a: day 1 -> day 3
                            ("b", T(2024, 1, 2, 6), None),        # b: replaced, NULL wins
                            ("e", T(2024, 1, 2, 7), "new")])       # e: insert
    expected = sorted(map(tuple, upsert(target, source, ["event_id"]).collect()), key=repr)
    res = store.upsert(source, "silver", "click_events")
    delta = res.delta
    assert {d["_event_date"] for d in res.touched} == {
        dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)}
    got = sorted(map(tuple, store.read("silver", "click_events").collect()), key=repr)
    assert got == expected
    assert delta == 1
    assert store._rows("silver", "click_events") == len(got) == 5
    raw = store.read("silver", "click_events", raw=True)
    assert raw.where("event_id = 'a'").select("_event_date").first()[0] == dt.date(2024, 1, 3)
    after = mtimes(vpath)
    assert all(after.get(k) == v for k, v in untouched.items())   # day 4 never rewritten
    staging_root = spark.conf.get("spark.checkpoint.dir").replace("file:", "") + "/tierflow-staging"
    assert not [d for d in (os.listdir(staging_root) if os.path.isdir(staging_root) else [])
                if d.startswith("silver-click_events-") and os.path.getmtime(
                    os.path.join(staging_root, d)) >= min(untouched.values())]


from hypothesis import given, settings, strategies as st

from tierflow.operators.dedup import latest_per_key

row = st.tuples(st.integers(0, 12),                                   # key
                st.one_of(st.none(), st.integers(1, 4)),              # day (NULL allowed)
                st.integers(0, 3))                                    # ingest hour


def _frame(spark, rows, tag):
    seen, out = set(), []
    for k, day, hour in rows:
        if k in seen:
            continue
        seen.add(k)
        ts = None if day is None else T(2024, 1, day, 5)
        out.append((f"k{k}", ts, f"{tag}{k}", T(2024, 2, 1, hour)))
    df = spark.createDataFrame(out or [("x", None, None, None)][:0],
                               "event_id string, ts_utc timestamp_ntz, device string, "
                               "_ingested_at timestamp_ntz")
    others = [f for f in C.SILVER_CLICKS.fields if f.name not in df.columns]
    return C.conform(df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others]),
                     C.SILVER_CLICKS)


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=15), st.lists(row, max_size=15), st.booleans())
def test_partition_upsert_equals_frame_upsert(spark, trows, srows, latest):
    store = LayerStore(spark, scratch_path(spark, "t-pu-prop"))
    target, source = _frame(spark, trows, "t"), _frame(spark, srows, "s")
    store.upsert(target, "silver", "click_events")
    order = ["ts_utc", "_ingested_at"]
    store.upsert(source, "silver", "click_events", prefer_latest=order if latest else None)
    if latest:
        want = latest_per_key(source.unionByName(target), ["event_id"], order)
    else:
        want = upsert(target, source, ["event_id"])
    got = store.read("silver", "click_events")
    key = lambda r: repr(tuple(r))
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert store._rows("silver", "click_events") == got.count()


def test_thousands_of_partitions_and_a_root_with_a_space(spark):
    store = LayerStore(spark, scratch_path(spark, "t my lake"))
    store.upsert(clicks(spark, [("a", T(2024, 1, 1, 5), "x"), ("b", T(2024, 1, 2, 5), "x")]), "silver", "click_events")
    store.upsert(clicks(spark, [("a", T(2024, 1, 3, 5), "moved")]), "silver", "click_events")
    got = store.read("silver", "click_events")
    assert sorted((r.event_id, r.device) for r in got.collect()) == [("a", "moved"), ("b", "x")]
    days = [{"_event_date": dt.date(2000, 1, 1) + dt.timedelta(days=i)} for i in range(9000)] + [{"_event_date": None}]
    raw = store.read("silver", "click_events", raw=True)
    assert raw.where(store._any_match(days, ["_event_date"])).count() == 2
    assert raw.where(store._any_match(days[:5], ["_event_date"])).count() == 0


def test_ties_do_not_depend_on_the_layout(spark):
    store = LayerStore(spark, scratch_path(spark, "t-pu-ties"))
    rows = [(k, None if k % 2 else 1, 0) for k in range(16)]
    target, source = _frame(spark, rows, "t"), _frame(spark, rows, "s")
    order = ["ts_utc", "_ingested_at"]
    store.upsert(target, "silver", "click_events")
    store.upsert(source, "silver", "click_events", prefer_latest=order)
    want = latest_per_key(source.unionByName(target), ["event_id"], order)
    winners = lambda df: {r["event_id"]: r["device"] for r in df.collect()}
    assert winners(store.read("silver", "click_events")) == winners(want)
