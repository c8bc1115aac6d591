"""Command line: one run of the medallion pipeline plus its verification.

    python -m tierflow --lake PATH [--clicks GLOB] [--with-orders]
                       [--orders-parquet PATH | --orders-jdbc-table NAME
                        --orders-split-column order_id --orders-bounds 0 1000000]
    python -m tierflow --lake PATH --clicks FOLDER --stream [--trigger '1 minute']

Clicks default to ``$CLICKSTREAM_PATH``.  Orders come from a parquet
snapshot or from a JDBC table (connection from ``$OLTP_JDBC_URL``,
``$OLTP_USER``, ``$OLTP_PASSWORD``).  After the run the audit, key checks
and the daily revenue report are printed.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from tierflow.plans import quality, runner
from tierflow.session import build_session
from tierflow.sources import jdbc, jsonl
from tierflow.sources.layers import LayerStore
from tierflow.streaming import incremental


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tierflow", description="bronze -> silver -> gold run")
    p.add_argument("--lake", required=True, help="root folder of the layer tables")
    p.add_argument("--clicks", default=os.environ.get("CLICKSTREAM_PATH"),
                   help="JSON-lines click files (glob); default $CLICKSTREAM_PATH")
    p.add_argument("--with-orders", action="store_true", help="also stage and upsert silver.orders")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--orders-parquet", help="OLTP orders snapshot as parquet")
    src.add_argument("--orders-jdbc-table", help="OLTP orders table read over JDBC")
    p.add_argument("--orders-split-column", default="order_id")
    p.add_argument("--orders-bounds", nargs=2, type=int, metavar=("LOWER", "UPPER"))
    p.add_argument("--orders-partitions", type=int, default=16)
    p.add_argument("--full", action="store_true",
                   help="re-stage all of bronze instead of only new loads")
    p.add_argument("--stream", action="store_true",
                   help="run the incremental streaming job on the --clicks folder instead "
                        "(landed files may carry _ingested_at)")
    p.add_argument("--trigger", default=None,
                   help="with --stream: keep running with this processing-time trigger "
                        "(e.g. '1 minute'); default: process what is there, then stop")
    p.add_argument("--keep-versions", type=int, default=2,
                   help="version folders kept per table (older ones are deleted)")
    p.add_argument("--load-id", default=None,
                   help="read all files as one load of that name, which is not loaded again; "
                        "by default each file is loaded once")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    a = p.parse_args(argv)
    if not a.clicks:
        p.error("no click files: pass --clicks or set CLICKSTREAM_PATH")
    return a


def main(argv: list[str] | None = None, spark=None) -> dict:
    a = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or build_session(a.master, app="tierflow-run")
    store = LayerStore(spark, a.lake)
    if a.stream:
        q = incremental.start_clicks(spark, a.clicks, store, incremental.checkpoint_of(store),
                                     available_now=a.trigger is None, processing_time=a.trigger)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        quality.audit(store).orderBy("layer", "table").show(truncate=False)
        return {"silver.click_events": store._rows("silver", "click_events")}
    orders = None
    if a.orders_parquet:
        orders = spark.read.parquet(a.orders_parquet)
    elif a.orders_jdbc_table:
        conn = jdbc.connection("OLTP_JDBC_URL", "OLTP_USER", "OLTP_PASSWORD")
        if not a.orders_bounds:
            raise SystemExit("--orders-jdbc-table needs --orders-bounds: without them one task reads the table")
        kw = dict(partition_column=a.orders_split_column, lower_bound=a.orders_bounds[0],
                  upper_bound=a.orders_bounds[1], num_partitions=a.orders_partitions)
        orders = jdbc.read(spark, conn, a.orders_jdbc_table, **kw)
    clicks, landed = None, {}
    if a.load_id is None:
        landed = incremental.land_files(store, a.clicks)    # each file once, whoever loads it
    else:
        clicks = jsonl.read_clicks(spark, a.clicks)
    if clicks is None and not store.exists("bronze", "click_events"):
        raise SystemExit(f"no click files at {a.clicks}")
    counts = runner.run(store, clicks, orders,
                        with_orders=a.with_orders, incremental=not a.full,
                        keep_versions=a.keep_versions, load_id=a.load_id)
    for table, rows in landed.items():
        counts[table] += rows
    print(json.dumps({"rows_written": counts}))
    quality.audit(store).orderBy("layer", "table").show(truncate=False)
    quality.contract_report(store).orderBy("layer", "table").show(truncate=False)
    for row in runner.report_daily_revenue(store).toLocalIterator():   # the whole report, a row per day
        print("\t".join("NULL" if v is None else str(v) for v in row))
    return counts


if __name__ == "__main__":
    main()
