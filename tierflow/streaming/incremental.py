"""Incremental bronze -> silver for click files (Structured Streaming).

New JSON-lines files are picked up by a file stream; every micro-batch is
handed to the batch functions through ``foreachBatch``:

1. bronze: the batch is shaped (``bronze.clicks``) and appended as a load;
2. silver: all loads that silver doesn't hold yet are merged
   (``runner.merge_loads``, the step of the batch run), so that the latest
   delivery wins against the stored row: the result equals a full recompute
   even when an older re-delivery arrives late, and only the event days the
   loads touch are read and rewritten.  Rows whose event_id is NULL go to
   ``silver.click_events_rejected``.

The bronze commit records the micro-batch epoch: a batch replayed after a
failure is not appended again, and its load is merged if it wasn't.  So each
file affects the tables once, and batch runs and streams may share a lake.
The stream's own checkpoint (offsets, file log) lives in the lake; the batch
command uses the same one (``land_files``), so a file that either has taken is
not taken again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tierflow import contracts as C
from tierflow.plans import bronze
from tierflow.plans.runner import merge_loads
from tierflow.sources.jsonl import with_malformed
from tierflow.sources.layers import LayerStore

# JSON text form of timestamp_ntz values in landed files (microseconds kept)
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_landed_clicks(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = with_malformed(spark.readStream, C.LANDED_CLICK).option("timestampNTZFormat", NTZ_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def process_batch(store: LayerStore, batch: DataFrame, epoch: int, run_ts=None) -> None:
    """Apply one micro-batch of landed clicks to bronze and silver."""
    store.refresh()                                 # see commits of other writers
    if epoch > store.last_epoch("bronze", "click_events"):
        store.append(bronze.clicks(batch, run_ts), "bronze", "click_events", epoch=epoch)
    merge_loads(store, run_ts)


def checkpoint_of(store: LayerStore) -> str:
    """The file log of a lake's click files."""
    return f"{store.root}/_stream_checkpoint"


def land_files(store: LayerStore, source_path: str, run_ts=None) -> dict[str, int]:
    """Load every click file that the lake hasn't taken yet, and merge it;
    returns the rows written per append-only table."""
    tables = [("bronze", "click_events"), ("silver", "click_events_rejected")]
    before = [store._rows(*t) for t in tables]
    q = start_clicks(store.spark, source_path, store, checkpoint_of(store), run_ts)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return {".".join(t): store._rows(*t) - n for t, n in zip(tables, before)}


def start_clicks(spark: SparkSession, source_path: str, store: LayerStore, checkpoint: str,
                 run_ts=None, available_now: bool = True,
                 processing_time: str | None = None,
                 max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Start the incremental job.  ``available_now`` processes every file
    present and stops (a scheduled incremental run); otherwise the query
    keeps running with a ``processing_time`` trigger.  A backlog is split
    into micro-batches of at most ``max_files_per_trigger`` files, which
    bounds what one batch holds."""
    stream = read_landed_clicks(spark, source_path, max_files_per_trigger)
    w = (stream.writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: process_batch(store, df, epoch, run_ts)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
