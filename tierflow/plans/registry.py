"""Named, reproducible queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Loads are
stamped with fixed times so results can be compared with an independent
SQL oracle (``tierflow_oracle.py``).  Entries that exercise sinks write to a fresh
folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.functions import variant
from tierflow.functions.clean import collapse_slashes, norm_lower, with_json_fields
from tierflow.operators.changes import apply_changes
from tierflow.operators.items import lookup, low_stock, validity
from tierflow.operators.snapshots import changed_keys
from tierflow.operators.upsert import upsert
from tierflow.plans import bronze, gold, quality, runner, silver
from tierflow.session import ensure_checkpoint_dir, scratch_path
from tierflow.sources import jsonl, shapes
from tierflow.sources import testdata as td
from tierflow.sources.layers import LayerStore

# ---- fixed values -------------------------------------------------------
RUN_TS = td.RUN_TS                  # stamp of the first run
RUN_TS2 = "2025-01-03 00:00:00"     # stamp of the later run (upserts, changes)
# -------------------------------------------------------------------------


def _store(spark: SparkSession, name: str) -> LayerStore:
    ensure_checkpoint_dir(spark)
    return LayerStore(spark, scratch_path(spark, name))


def _num(event_id: str = "event_id"):
    """numeric part of an event id ``e<n>``"""
    return F.substring(F.col(event_id), 2, 30).cast("bigint")


#: Attributes of the events that the adapters write.
METADATA = "browser string, campaign string, country string, device string, k bigint, os string, search_term string"


# ---- bronze ---------------------------------------------------------------
def bronze_clicks(spark, d):
    return bronze.clicks(td.raw_clicks(spark, d), RUN_TS)


def bronze_clicks_raw(spark, d):
    raw = bronze.clicks(td.raw_clicks(spark, d), RUN_TS, parse=False)
    return raw.select(*[c for c in raw.columns if c != "metadata"],
                      *[F.col(f"metadata.{f}").alias(f"metadata_{f}")
                        for f in ("browser", "campaign", "country", "device", "k", "os", "search_term")])


def bronze_orders(spark, d):
    return bronze.orders(td.oltp_orders(spark, d), RUN_TS)


def scan_jsonl_clicks(spark, d):
    path = scratch_path(spark, "jsonl")
    jsonl.write_lines(td.raw_clicks(spark, d).drop("_ingested_at"), path)
    raw = jsonl.read_clicks(spark, path).withColumn("metadata", F.from_json("metadata", METADATA))
    return raw.select(*[c for c in bronze.RAW_CLICK_COLUMNS if c != "metadata"],
                      *[F.col(f"metadata.{f}").alias(f"metadata_{f}")
                        for f in ("browser", "campaign", "country", "device", "k", "os", "search_term")])


def scan_open_clicks(spark, d):
    """Lines with metadata keys of any name and type, and lines that are no
    JSON: both keep their text."""
    path = scratch_path(spark, "jsonl-open")
    td.click_lines(spark, d).write.text(path)
    return bronze.clicks(jsonl.read_clicks(spark, path), RUN_TS).select("event_id", "user_id", "metadata_json")


def _open_clicks(spark, d):
    path = scratch_path(spark, "jsonl-open")
    td.click_lines(spark, d).write.text(path)
    return variant.with_variant(bronze.clicks(jsonl.read_clicks(spark, path), RUN_TS))


def metadata_at(spark, d):
    """Single paths of open metadata, typed; text where a number was asked for
    gives NULL."""
    return _open_clicks(spark, d).select(
        "event_id", variant.at("metadata", "$.plan").alias("plan"),
        variant.at("metadata", "$.k").alias("k"), variant.at("metadata", "$.k", "bigint").alias("k_number"),
        variant.at("metadata", "$.tags[0]").alias("tag"), variant.at("metadata", "$.tags[1]", "bigint").alias("tag_user"),
        variant.at("metadata", "$.none.at.all").alias("absent"), variant.at("metadata", "$._malformed").alias("malformed"))


def metadata_report(spark, d):
    """Every path that open metadata holds, with how often and of what type."""
    return variant.path_report(_open_clicks(spark, d))


def _orders_feed(spark, d):
    path = scratch_path(spark, "orders-feed")
    td.order_lines(spark, d).write.partitionBy("shape").text(path)
    return shapes.read_lines(spark, f"{path}/shape=*", C.ORDERS_FEED)


def orders_of_shapes(spark, d):
    """One scan over files of four shapes; each step of the time fallback
    decides some orders."""
    return silver.orders(_orders_feed(spark, d), RUN_TS, dedup=True, tolerant=True)


def orders_shape_conflicts(spark, d):
    """The columns of each order of the feed that could not be given their type."""
    return _orders_feed(spark, d).select("order_id", F.array_join(shapes.CONFLICTS, ",").alias("conflicts"))


def bronze_append(spark, d):
    store = _store(spark, "append")
    for part in ("first", "second"):
        b = bronze.clicks(td.raw_clicks(spark, d, deliveries=part), RUN_TS)
        store.append(b, "bronze", "click_events")
    return store.read("bronze", "click_events")


# ---- scalar cleaning ------------------------------------------------------
def clean_status(spark, d):
    b = bronze_orders(spark, d)
    return b.select("order_id", norm_lower("status").alias("status"))


def clean_paths(spark, d):
    pages = td.table(spark, d, "pages")
    return pages.select("page_id", collapse_slashes("url").alias("url_path"))


def json_extract(spark, d):
    names = ("browser", "os", "device", "country", "campaign", "search_term")
    b = bronze_clicks(spark, d).select("event_id", "_ingested_at", "metadata_json")
    return with_json_fields(b, "metadata_json", names).select("event_id", "_ingested_at", *names)


# ---- silver ---------------------------------------------------------------
def silver_orders(spark, d):
    return silver.orders(bronze_orders(spark, d), RUN_TS)


def silver_orders_dedup(spark, d):
    b = bronze.orders(td.bronze_orders_input(spark, d, redeliveries=True))
    return silver.orders(b, RUN_TS, dedup=True)


def schema_tolerant_orders(spark, d):
    return silver.orders(td.legacy_orders(spark, d), RUN_TS, dedup=True, tolerant=True)


def silver_clicks(spark, d):
    return silver.clicks(bronze_clicks(spark, d), RUN_TS)


def rejected_clicks(spark, d):
    """Every row that has no key, as stored by a run."""
    return _full_run(spark, d, "rejected").read("silver", "click_events_rejected")


# ---- upserts --------------------------------------------------------------
def upsert_orders(spark, d):
    """Target: orders whose id is not a multiple of 3.  Source: multiples of
    3 (new keys: inserts) and even ids (updates with changed amounts and
    some NULL statuses).  Together they cover every order; odd ids that are
    not multiples of 3 exist only in the target and are kept."""
    target, source = _orders_upsert(spark, d)
    return upsert(target, source, ["order_id"])


def _orders_upsert(spark, d):
    base = silver_orders(spark, d)
    return base.where(F.col("order_id") % 3 != 0), base.where((F.col("order_id") % 3 == 0) | (F.col("order_id") % 2 == 0)).withColumns({
        "amount": (F.col("amount") + 10).cast("decimal(18,2)"),
        "status": F.when(F.col("order_id") % 8 == 0, F.lit(None)).otherwise(F.col("status")),
        "_processed_at": F.lit(RUN_TS2).cast("timestamp_ntz")})


def upsert_orders_buckets(spark, d):
    """The rows of ``upsert_orders`` merged into a stored silver.orders, bucket
    by bucket."""
    store = _store(spark, "buckets")
    target, source = _orders_upsert(spark, d)
    store.overwrite(target, "silver", "orders")
    store.upsert(source, "silver", "orders")
    return store.read("silver", "orders")


def upsert_clicks(spark, d):
    """Target: silver built from the first deliveries, ids not multiples of
    3.  Source: silver from all deliveries, ids that are multiples of 3
    (inserts) or even (replacements).  Together they cover every keyed
    event (a NULL id cannot be upserted)."""
    target = silver.clicks(bronze.clicks(td.raw_clicks(spark, d, "first"), RUN_TS), RUN_TS)
    target = target.where(_num() % 3 != 0)
    source = silver.clicks(bronze_clicks(spark, d), RUN_TS2) \
        .where((_num() % 3 == 0) | (_num() % 2 == 0))
    return upsert(target, source, ["event_id"])


# ---- gold -----------------------------------------------------------------
def _gold_inputs(spark, d):
    return (gold.prepare_clicks(silver_clicks(spark, d)),
            gold.prepare_orders(bronze_orders(spark, d)))


def gold_dim_user(spark, d):
    clicks, orders = _gold_inputs(spark, d)
    return gold.dim_user(clicks, orders)


def gold_fact_orders(spark, d):
    return gold.fact_orders(gold.prepare_orders(bronze_orders(spark, d)))


def gold_fact_clicks(spark, d):
    return gold.fact_clicks(gold.prepare_clicks(silver_clicks(spark, d)), unique_events=True)


def gold_orders_daily_revenue(spark, d):
    return gold.orders_daily_revenue(gold.prepare_orders(bronze_orders(spark, d)),
                                     unique_orders=True)


def gold_daily_loads(spark, d):
    """The daily mart of two loads: all orders, then the re-deliveries, some
    of them on the day of the first delivery."""
    store = _store(spark, "daily")
    every = td.bronze_orders_input(spark, d, redeliveries=True)
    first = F.col("_ingested_at") == F.lit(RUN_TS).cast("timestamp_ntz")
    for load_id, part in (("first", every.where(first)), ("again", every.where(~first))):
        runner.add_orders(store, bronze.orders(part), load_id)
    return store.read("gold", "orders_daily_revenue")


def orders_changes(spark, d):
    """What became of each order between two snapshots."""
    return changed_keys(td.earlier_orders(spark, d), td.oltp_orders(spark, d), ["order_id"])


def _refreshed(spark, d, name):
    """Orders gold of an earlier snapshot, refreshed to the current one."""
    store = _store(spark, name)
    for snapshot in (td.earlier_orders(spark, d), td.oltp_orders(spark, d)):
        store.overwrite(bronze.orders(snapshot, RUN_TS), "bronze", "orders")
        runner.refresh_orders_gold(store)
    return store


def gold_orders_refresh(spark, d):
    return _refreshed(spark, d, "refresh-facts").read("gold", "fact_orders")


def gold_daily_refresh(spark, d):
    return _refreshed(spark, d, "refresh-daily").read("gold", "orders_daily_revenue")


def report_daily_revenue(spark, d):
    store = _store(spark, "report")
    store.overwrite(gold_orders_daily_revenue(spark, d), "gold", "orders_daily_revenue")
    return runner.report_daily_revenue(store)


# ---- items ----------------------------------------------------------------
def items_snapshot(spark, d):
    store = _store(spark, "items")
    store.overwrite(td.items(spark, d), "app", "inventory_items")
    return store.read("app", "inventory_items")


def items_lookup(spark, d):
    return lookup(td.items(spark, d), td.wanted_item_ids(spark, d))


def items_low_stock(spark, d):
    return low_stock(td.items(spark, d)).select("id", "quantity", "low_stock")


def items_validity(spark, d):
    return validity(td.item_changes(spark, d))


def items_apply_changes(spark, d):
    return apply_changes(td.items(spark, d), td.item_changes(spark, d), run_ts=RUN_TS2)


# ---- incremental ----------------------------------------------------------
def stream_silver_clicks(spark, d):
    """Two landings (first delivery, then re-deliveries) processed by two
    scheduled incremental runs of the streaming job; the silver table must
    equal a full batch recompute (minus the unkeyable NULL-id row)."""
    from tierflow.streaming import incremental
    root = scratch_path(spark, "stream")
    store = LayerStore(spark, f"{root}/tables")
    for part in ("first", "second"):
        (td.raw_clicks(spark, d, deliveries=part).write.mode("append")
           .option("timestampNTZFormat", incremental.NTZ_FORMAT)
           .json(f"{root}/landing/{part}"))
        q = incremental.start_clicks(spark, f"{root}/landing/*", store, f"{root}/_checkpoint",
                                     run_ts=RUN_TS)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return store.read("silver", "click_events")


# ---- whole runs -----------------------------------------------------------
def _full_run(spark, d, name):
    store = _store(spark, name)
    runner.run(store, td.raw_clicks(spark, d), td.oltp_orders(spark, d),
                 with_orders=True, run_ts=RUN_TS)
    return store


def run_audit(spark, d):
    return quality.audit(_full_run(spark, d, "audit"))


def contract_check(spark, d):
    return quality.contract_report(_full_run(spark, d, "contract"))


def run_reconcile(spark, d):
    """Whether every delivered click is stored, superseded or rejected."""
    return quality.reconcile_clicks(_full_run(spark, d, "reconcile")).select("part", "rows")


def catalog_tables(spark, d):
    """Row counts of a run's tables, read by name through the session's catalog
    after every DDL has run."""
    store = _full_run(spark, d, "catalog")
    prefix = f"lake_{store.root.rstrip('/').rsplit('-', 1)[-1]}_".lower()
    counts = [f"""SELECT '{db[len(prefix):]}' AS layer, '{table}' AS `table`, count(*) AS rows FROM {db}.{table}"""
              for db, table in (name.split(".") for name in store.register_tables(prefix))]
    return spark.sql(" UNION ALL ".join(counts))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_clicks": bronze_clicks,
    "bronze_clicks_raw": bronze_clicks_raw,
    "bronze_orders": bronze_orders,
    "scan_jsonl_clicks": scan_jsonl_clicks,
    "scan_open_clicks": scan_open_clicks,
    "metadata_at": metadata_at,
    "metadata_report": metadata_report,
    "orders_of_shapes": orders_of_shapes,
    "orders_shape_conflicts": orders_shape_conflicts,
    "bronze_append": bronze_append,
    "clean_status": clean_status,
    "clean_paths": clean_paths,
    "json_extract": json_extract,
    "silver_orders": silver_orders,
    "silver_orders_dedup": silver_orders_dedup,
    "schema_tolerant_orders": schema_tolerant_orders,
    "silver_clicks": silver_clicks,
    "rejected_clicks": rejected_clicks,
    "upsert_orders": upsert_orders,
    "upsert_orders_buckets": upsert_orders_buckets,
    "upsert_clicks": upsert_clicks,
    "gold_dim_user": gold_dim_user,
    "gold_fact_orders": gold_fact_orders,
    "gold_fact_clicks": gold_fact_clicks,
    "gold_orders_daily_revenue": gold_orders_daily_revenue,
    "gold_daily_loads": gold_daily_loads,
    "orders_changes": orders_changes,
    "gold_orders_refresh": gold_orders_refresh,
    "gold_daily_refresh": gold_daily_refresh,
    "report_daily_revenue": report_daily_revenue,
    "items_snapshot": items_snapshot,
    "items_lookup": items_lookup,
    "items_low_stock": items_low_stock,
    "items_validity": items_validity,
    "items_apply_changes": items_apply_changes,
    "stream_silver_clicks": stream_silver_clicks,
    "run_audit": run_audit,
    "contract_check": contract_check,
    "run_reconcile": run_reconcile,
    "catalog_tables": catalog_tables,
}
