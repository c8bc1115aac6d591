"""Incremental job: a replayed micro-batch changes nothing."""

from tierflow.session import scratch_path
from tierflow.sources import testdata as td
from tierflow.sources.layers import LayerStore
from tierflow.streaming.incremental import process_batch

from tests.conftest import SF001


def test_replayed_batch_is_skipped(spark):
    store = LayerStore(spark, scratch_path(spark, "t-stream"))
    first = td.raw_clicks(spark, SF001, "first")
    second = td.raw_clicks(spark, SF001, "second")
    process_batch(store, first, 0, run_ts=td.RUN_TS)
    process_batch(store, second, 1, run_ts=td.RUN_TS)
    silver1 = store.read("silver", "click_events").count()
    bronze1 = store.read("bronze", "click_events").count()
    process_batch(store, second, 1, run_ts=td.RUN_TS)      # replay after a failure
    assert store.read("silver", "click_events").count() == silver1
    assert store.read("bronze", "click_events").count() == bronze1
    assert bronze1 == first.count() + second.count()


def test_late_older_delivery_does_not_win(spark):
    store = LayerStore(spark, scratch_path(spark, "t-late"))
    second = td.raw_clicks(spark, SF001, "second")
    first = td.raw_clicks(spark, SF001, "first")
    # newer deliveries first, then the older first deliveries arrive late
    process_batch(store, second, 0, run_ts=td.RUN_TS)
    process_batch(store, first, 1, run_ts=td.RUN_TS)
    store2 = LayerStore(spark, scratch_path(spark, "t-late2"))
    process_batch(store2, first, 0, run_ts=td.RUN_TS)
    process_batch(store2, second, 1, run_ts=td.RUN_TS)
    a = store.read("silver", "click_events")
    b = store2.read("silver", "click_events")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_command_line_stream(spark):
    from tierflow.__main__ import main
    from tierflow.streaming.incremental import NTZ_FORMAT
    root = scratch_path(spark, "t-cli-stream")
    td.raw_clicks(spark, SF001).write.option("timestampNTZFormat", NTZ_FORMAT).json(f"{root}/landing")
    out = main(["--lake", f"{root}/lake", "--clicks", f"{root}/landing", "--stream"], spark=spark)
    # 1,000 events; the 1 event with a NULL id is rejected, re-deliveries merge
    assert out["silver.click_events"] == 999


def _state(store):
    store.refresh()
    keys = store.read("silver", "click_events").select("event_id", "ts_utc", "_ingested_at")
    return (store.read("bronze", "click_events").count(), store.read("silver", "click_events_rejected").count(),
            sorted(map(str, keys.collect())))


def _land(spark, root, part):
    from tierflow.streaming.incremental import NTZ_FORMAT
    (td.raw_clicks(spark, SF001, part).write.mode("append").option("timestampNTZFormat", NTZ_FORMAT)
       .json(f"{root}/landing"))


def test_stream_and_batch_share_a_lake(spark):
    """Stream then batch, batch then stream, and each command twice: bronze,
    silver and rejected rows are those of one run over all files."""
    from tierflow.__main__ import main
    states = []
    for order in (["--stream", None], [None, "--stream"], [None, None]):
        root = scratch_path(spark, "t-share")
        store = LayerStore(spark, f"{root}/lake")
        for part, flag in zip(("first", "second"), order):
            _land(spark, root, part)
            args = ["--lake", f"{root}/lake", "--clicks", f"{root}/landing"] + ([flag] if flag else [])
            main(args, spark=spark)
            once = _state(store)
            main(args, spark=spark)
            assert _state(store) == once
        states.append(once)
    n = sum(td.raw_clicks(spark, SF001, p).count() for p in ("first", "second"))
    unkeyed = td.raw_clicks(spark, SF001).where("event_id is null").count()
    assert states[0][:2] == (n, unkeyed)
    assert states[0] == states[1] == states[2]


def test_a_load_left_by_a_stopped_run_is_merged_once(spark):
    from tierflow.plans import bronze, runner
    store = LayerStore(spark, scratch_path(spark, "t-left"))
    store.append(bronze.clicks(td.raw_clicks(spark, SF001, "first"), td.RUN_TS), "bronze", "click_events")
    process_batch(store, td.raw_clicks(spark, SF001, "second"), 0, run_ts=td.RUN_TS)
    got = _state(store)
    assert runner.merge_loads(store, td.RUN_TS) == (0, None) and _state(store) == got
    assert got[0] == td.raw_clicks(spark, SF001).count()


def test_batches_without_rejected_rows_leave_no_folder(spark):
    store = LayerStore(spark, scratch_path(spark, "t-norej"))
    keyed = td.raw_clicks(spark, SF001, "first").where("event_id is not null")
    process_batch(store, keyed, 0, run_ts=td.RUN_TS)
    commits = len(store._log_rows("silver", "click_events_rejected"))
    process_batch(store, keyed, 1, run_ts=td.RUN_TS)
    assert len(store._log_rows("silver", "click_events_rejected")) == commits == 1
    assert store.read("silver", "click_events_rejected").isEmpty()
