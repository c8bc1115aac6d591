"""Operators against brute-force Python on small fixtures, including a hot
key that holds about a third of all rows."""

import datetime as dt
import random

from hypothesis import given, settings, strategies as st

from tierflow.operators.changes import apply_changes
from tierflow.operators.dedup import latest_per_key
from tierflow.plans import gold

T0 = dt.datetime(2025, 1, 1)
STAMP = dt.datetime(2025, 2, 1)
ITEMS = "id bigint, name string, sku string, quantity int, location string, updated_at timestamp_ntz"
CHG = "seq bigint, op string, id bigint, name string, sku string, quantity int, location string"


def sequential(snapshot, changes):
    """The service's semantics: one change at a time, in seq order."""
    rows = {r[0]: list(r) for r in snapshot}
    next_id = max(rows, default=0) + 1
    for seq, op, id_, name, sku, qty, loc in sorted(changes):
        if op == "create":
            if id_ is None:
                rows[next_id] = [next_id, name, sku, qty, loc, STAMP]
                next_id += 1
        elif op == "update" and id_ in rows:
            rows[id_] = [id_, name, sku, qty, loc, STAMP]
        elif op == "delete":
            rows.pop(id_, None)
    return sorted(tuple(r) for r in rows.values())


change = st.tuples(st.sampled_from(["create", "update", "delete"]),
                   # existing ids 1..6 (3 is hot) or unknown ones; ids of creates in the
                   # same set are assigned while applying it and cannot be referenced
                   st.one_of(st.just(3), st.integers(1, 6), st.integers(-3, -1)),
                   st.sampled_from(["a", "b", None]), st.integers(0, 9))


@settings(max_examples=10, deadline=None)
@given(st.lists(change, max_size=30), st.integers(0, 2**16))
def test_apply_changes_equals_sequential(spark, raw, seed):
    snap = [(i, f"n{i}", f"s{i}", i, f"l{i}", T0) for i in range(1, 7)]
    rnd = random.Random(seed)
    seqs = rnd.sample(range(1000), len(raw))
    changes = []
    for seq, (op, id_, name, qty) in zip(seqs, raw):
        cid = None if (op == "create" and rnd.random() < 0.8) else id_
        changes.append((seq, op, cid, name, "k", qty, "L"))
    got = apply_changes(spark.createDataFrame(snap, ITEMS),
                        spark.createDataFrame(changes, CHG), run_ts="2025-02-01 00:00:00")
    assert sorted(tuple(r) for r in got.collect()) == sequential(snap, changes)


def test_dedup_hot_key_matches_bruteforce(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = None if i % 6 == 0 else ("hot" if i % 3 == 0 else f"k{rnd.randint(0, 400)}")
        ts = None if rnd.random() < 0.1 else T0 + dt.timedelta(minutes=rnd.randint(0, 50))
        rows.append((k, ts, T0 + dt.timedelta(seconds=i), i))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, ing timestamp_ntz, v int").repartition(7)
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts", "ing"]).collect()}
    want = {}
    for k, ts, ing, v in rows:
        best = want.get(k)
        key = (ts is not None, ts or T0, ing)
        if best is None or key > best[0]:
            want[k] = (key, v)
    assert got == {k: v for k, (_, v) in want.items()}


def test_fact_clicks_hot_group_matches_bruteforce(spark):
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((f"e{i}", None if hot else i % 50, "s" if hot else f"s{i % 40}", "/",
                     "click", T0 + dt.timedelta(hours=0 if hot else i % 72)))
    df = spark.createDataFrame(rows, "event_id string, user_id bigint, session_id string, "
                                     "page string, event_type string, ts_utc timestamp_ntz")
    want = {}
    for e, u, sid, page, et, ts in rows:
        key = (sid, u, page, et, int(ts.strftime("%Y%m%d")))
        want.setdefault(key, set()).add(e)
    for unique in (True, False):
        got = {(r.session_id, r.user_id, r.page, r.event_type, r.event_date_key): r.events_count
               for r in gold.fact_clicks(df, unique_events=unique).collect()}
        assert got == {k: len(v) for k, v in want.items()}
