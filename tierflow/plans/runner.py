"""One run of the whole medallion pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import contracts as C
from tierflow.functions.clean import to_day
from tierflow.operators.changes import apply_changes
from tierflow.operators.items import validity
from tierflow.operators.snapshots import changed_rows
from tierflow.plans import bronze, gold, silver
from tierflow.sources.layers import LayerStore, UpsertResult


def run(store: LayerStore, raw_clicks: DataFrame | None, oltp_orders: DataFrame | None = None,
        with_orders: bool = False, run_ts=None, incremental: bool = True,
        keep_versions: int | None = 2, load_id: str | None = None) -> dict[str, int]:
    """bronze -> silver (upsert) -> gold, like the runner script.

    * bronze.click_events: append, partitioned by ingest day;
      bronze.orders: full snapshot replace (when ``oltp_orders`` is given).
    * silver.orders (only ``with_orders``): cleaned + de-duplicated stage,
      upserted on order_id.
    * silver.click_events: cleaned + de-duplicated stage, merged on
      event_id so that the latest delivery wins (by ts, then _ingested_at)
      against what silver already holds; only the event days it touches are
      rewritten (of undated events, the parts of its ingest days).  incremental=True (default) stages only the bronze loads
      not merged yet; because the merge keeps the latest delivery, the
      result equals re-staging all of bronze (incremental=False, the
      original job's way).  Rows whose event_id is NULL cannot be keyed;
      they go to ``silver.click_events_rejected`` instead of being dropped.
    * gold: dim_user is rebuilt in full each run (idempotent); fact_orders
      and orders_daily_revenue are rebuilt for the months in which the orders
      snapshot changed (``refresh_orders_gold``), fact_clicks for the
      months whose silver days changed.  It records the silver commit it was
      built from; if silver has gone on without it (a stopped run, the
      streaming job), or on its first build, it is rebuilt in full.

    Every table version and load is written before it is committed, so an
    interrupted run leaves the previous state readable.  ``load_id`` names
    the clicks given: a load of an id that is already committed is skipped, so
    a run repeated with its id adds nothing to bronze.  At the end, version folders older than the
    newest ``keep_versions`` are deleted (None keeps all).  ``raw_clicks`` is
    None where the file stream has landed them (``incremental.land_files``),
    which needs no id: it takes each file once.  Returns the rows written per
    table.
    """
    if with_orders and oltp_orders is None and not store.exists("bronze", "orders"):
        raise FileNotFoundError("with_orders=True but there is no orders input")
    counts: dict[str, int] = {}

    known = load_id is not None and store.has_load("bronze", "click_events", load_id)
    counts["bronze.click_events"] = 0 if raw_clicks is None or known else store.append(
        bronze.clicks(raw_clicks, run_ts), "bronze", "click_events", load_id=load_id)
    if oltp_orders is not None:
        counts["bronze.orders"] = store.overwrite(bronze.orders(oltp_orders, run_ts), "bronze", "orders")

    if with_orders:
        stage = silver.orders(store.read("bronze", "orders"), run_ts, dedup=True)
        store.upsert(stage, "silver", "orders")
        counts["silver.orders"] = store._rows("silver", "orders")

    before = store.last_commit("silver", "click_events")
    counts["silver.click_events_rejected"], merged = merge_loads(store, run_ts, incremental)
    counts["silver.click_events"] = store._rows("silver", "click_events")

    clicks = gold.prepare_clicks(store.read("silver", "click_events"))
    orders = gold.prepare_orders(store.read("bronze", "orders"))
    counts["gold.dim_user"] = store.overwrite(gold.dim_user(clicks, orders), "gold", "dim_user")
    refresh_orders_gold(store)
    counts["gold.fact_orders"] = store._rows("gold", "fact_orders")
    counts["gold.orders_daily_revenue"] = store._rows("gold", "orders_daily_revenue")
    now = store.last_commit("silver", "click_events")
    follows = before is not None and store.source_seq("gold", "fact_clicks") == before
    if merged is None and follows:
        pass                                        # silver is as the facts saw it
    elif merged is None or merged.touched is None or not follows:
        store.overwrite(gold.fact_clicks(clicks, unique_events=True), "gold", "fact_clicks", source_seq=now)
    else:
        refresh_fact_clicks(store, [d["_event_date"] for d in merged.touched], now)
    counts["gold.fact_clicks"] = store._rows("gold", "fact_clicks")
    if keep_versions is not None:
        for layer, table in C.TABLES:
            if store.exists(layer, table):
                store.vacuum(layer, table, keep_versions)
    return counts


def merge_loads(store: LayerStore, run_ts=None, incremental: bool = True) -> tuple[int, UpsertResult | None]:
    """Merge the bronze click loads that silver doesn't hold yet (all of them
    if not ``incremental``): keyed rows into silver.click_events, all others
    into silver.click_events_rejected.  Batch runs and the stream both come
    here, and each commit records the last load it covers, so whichever of
    them meets a load first takes it, and a load left by a stopped run is
    taken by the next.  Returns the rejected rows written, and what the upsert
    did (None if there was nothing to merge)."""
    loaded = store.last_load_seq("bronze", "click_events")
    done = store.source_seq("silver", "click_events") if incremental else None
    if loaded is None or done is not None and done >= loaded:
        return 0, None
    # rows rejected just before a stop are ahead of silver
    rejected_to = store.source_seq("silver", "click_events_rejected") if incremental else None
    rejected_to = max((x for x in (done, rejected_to) if x is not None), default=None)
    # every unkeyed row is kept: de-duplication by a NULL key would leave one
    unkeyed = store.read_loads_after("bronze", "click_events", rejected_to).where(F.col("event_id").isNull())
    rejected = 0
    if not unkeyed.isEmpty():                       # else neither a folder nor a commit
        write = store.append if incremental else store.overwrite
        rejected = write(silver.clicks(unkeyed, run_ts, dedup=False), "silver", "click_events_rejected",
                         source_seq=loaded)
    elif not store.exists("silver", "click_events_rejected"):
        store.overwrite(C.empty(store.spark, C.SILVER_CLICKS), "silver", "click_events_rejected", source_seq=loaded)
    keyed = store.read_loads_after("bronze", "click_events", done).where(F.col("event_id").isNotNull())
    return rejected, store.upsert(silver.clicks(keyed, run_ts), "silver", "click_events",
                                  prefer_latest=silver.DEDUP_ORDER_CLICKS, source_seq=loaded)


def refresh_fact_clicks(store: LayerStore, days: list, source_seq: int | None = None) -> int:
    """Recompute gold.fact_clicks for the months holding ``days`` (event
    days whose silver rows changed) from those silver partitions only, and
    replace just those month partitions.  ``source_seq`` is the silver commit
    they come from.  Returns the row delta."""
    months = sorted({None if d is None else d.year * 100 + d.month for d in days},
                    key=lambda m: (m is None, m))
    if not months:
        store._commit("gold", "fact_clicks", store.current_version("gold", "fact_clicks"), 0, source_seq=source_seq)
        return 0
    day = F.col("_event_date")
    # on the partition column alone, so it prunes folders
    cond = (F.year(day) * 100 + F.month(day)).isin([m for m in months if m is not None])
    if None in months:
        cond = day.isNull() | F.coalesce(cond, F.lit(False))
    part = C.conform(store.read("silver", "click_events", raw=True).where(cond), C.SILVER_CLICKS)
    facts = gold.fact_clicks(gold.prepare_clicks(part), unique_events=True)
    return store.replace_partitions(facts, "gold", "fact_clicks",
                                    [{"event_month": m} for m in months], source_seq)


def refresh_orders_gold(store: LayerStore) -> list[int | None] | None:
    """Bring gold.fact_orders and gold.orders_daily_revenue up to the stored
    orders snapshot, rewriting only months in which it changed.

    The snapshot that the facts were built from (their commits name its
    version) is compared with the current one on the columns that gold reads,
    so a new load stamp alone changes nothing.  Changed rows name the months
    they left and those they came to; these months are built again, all other
    partitions keep their files.  Both tables are rebuilt in full where there
    is nothing to compare: on the first build, when that snapshot is no longer
    kept, or when ``add_orders`` feeds the mart.  The mart is written first and
    the facts' commit records the snapshot, so a stop between them is made good
    by the next call.  Returns the months rewritten (None: all)."""
    now = store.current_version("bronze", "orders")
    base = store.source_seq("gold", "fact_orders")
    built = store.exists("gold", "orders_daily_revenue") and store.source_seq("gold", "orders_daily_revenue") is None
    if now is not None and base == now and built:
        return []
    orders = gold.prepare_orders(store.read("bronze", "orders"))
    earlier = store.read_version("bronze", "orders", base) if base is not None and built else None
    if earlier is None:
        store.overwrite(gold.orders_daily_revenue(orders), "gold", "orders_daily_revenue")
        store.overwrite(gold.fact_orders(orders), "gold", "fact_orders", source_seq=now)
        return None

    def by_month(df: DataFrame) -> DataFrame:
        day = to_day("order_ts")
        return df.withColumn("__month", F.year(day) * 100 + F.month(day))

    changed = changed_rows(by_month(gold.prepare_orders(earlier)), by_month(orders), ["__month"])
    months = [r[0] for r in changed.select("__month").distinct().collect()]         # one row a month
    if months:
        part = by_month(orders).where(store._any_match([{"__month": m} for m in months], ["__month"])).drop("__month")
        store.replace_partitions(gold.orders_daily_revenue(part), "gold", "orders_daily_revenue",
                                 [{"state_month": m} for m in months])
        store.replace_partitions(gold.fact_orders(part), "gold", "fact_orders",
                                 [{"order_month": m} for m in months], source_seq=now)
    else:
        store._commit("gold", "fact_orders", store.current_version("gold", "fact_orders"), 0, source_seq=now)
    return months


def add_orders(store: LayerStore, orders: DataFrame, load_id: str | None = None) -> int:
    """Add a load of bronze-shaped orders to the daily mart, re-deliveries and
    all, without reading earlier orders.

    The load's state (``gold.daily_state``) is appended as one committed load;
    then only its days are computed again, from the states of those days.  A
    load of a known ``load_id`` adds nothing, and a stop between the two steps
    is made good by the next load or by the same one.  Returns the days
    recomputed."""
    if load_id is None or not store.has_load("gold", "orders_daily_state", load_id):
        store.append(gold.daily_state(gold.prepare_orders(orders)), "gold", "orders_daily_state", load_id=load_id)
    after = store.source_seq("gold", "orders_daily_revenue")
    loaded = store.last_load_seq("gold", "orders_daily_state")
    if after is not None and after >= loaded:
        return 0
    new = store.read_loads_after("gold", "orders_daily_state", after)
    days = [r[0] for r in new.select("order_date").distinct().collect()]    # at most one row a day
    months = {None if d is None else d.year * 100 + d.month for d in days}
    its_days = store._any_match([{"order_date": d} for d in days], ["order_date"])
    state = store.read("gold", "orders_daily_state", raw=True).where(
        store._any_match([{"state_month": m} for m in months], ["state_month"]))     # prunes folders
    fresh = gold.daily_from_state(state.where(its_days))
    mart = store.read("gold", "orders_daily_revenue")
    kept = mart.where(~its_days) if days else mart
    store.overwrite(kept.unionByName(fresh), "gold", "orders_daily_revenue", source_seq=loaded)
    return len(days)


def apply_item_changes(store: LayerStore, changes: DataFrame, run_ts=None) -> dict:
    """Apply a change set to the stored item snapshot (``app.inventory_items``)
    and commit the result as its next version.

    New ids continue after the highest id ever assigned (kept in the commit
    log), so an id freed by a delete is never handed out again.  Returns
    the rows written and the validity report of the change set (invalid
    rows are reported, not silently dropped; see ``items.validity``).
    """
    snapshot = store.read("app", "inventory_items")
    before = snapshot.agg(F.max("id")).first()[0]          # one row to the driver
    floor = store.id_high("app", "inventory_items")
    out = apply_changes(snapshot, changes, run_ts=run_ts, id_floor=floor)
    rows = store.overwrite(out, "app", "inventory_items")
    top_new = store.read("app", "inventory_items").agg(F.max("id")).first()[0]      # of the files, whatever was observed
    seen = [x for x in (before, floor, top_new) if x is not None]
    if seen:
        store._commit("app", "inventory_items", store.current_version("app", "inventory_items"),
                      0, id_high=int(max(seen)))
    bad = validity(changes).where(~F.col("valid"))
    return {"rows": rows, "invalid_changes": bad}


def report_daily_revenue(store: LayerStore) -> DataFrame:
    """H2: the stored daily mart, ordered by day (order is applied on read),
    as the SQL report the runner prints."""
    store.register_views()
    return store.spark.sql("SELECT * FROM gold_orders_daily_revenue ORDER BY order_date")
