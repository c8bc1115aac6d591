"""Key checks, contract checks and the post-run audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import contracts as C
from tierflow.operators.snapshots import row_hash
from tierflow.plans import silver
from tierflow.sources.layers import LayerStore


def check_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``rows``, ``null_keys`` (rows with a NULL key column) and
    ``duplicate_keys`` (non-NULL keys held by more than one row).

    Plan: a partial + final count per key (one shuffle of the key columns
    only), then a one-row global aggregate of those counts.
    """
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    per_key = (df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("__null", null_any))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count(F.when(~F.col("__null") & (F.col("n") > 1), F.lit(1))).cast("bigint").alias("duplicate_keys"))


def check_contract(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences between a frame's schema and a contract (names, order
    and types); an empty list means the frame conforms.  Metadata only:
    no data is read."""
    problems = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    extra = [n for n in have if n not in {f.name for f in schema.fields}]
    problems += [f"unexpected column {n}" for n in extra]
    if not problems and [f.name for f in df.schema.fields] != schema.fieldNames():
        problems.append("column order differs")
    return problems


def _stored(store: LayerStore) -> list[tuple[str, str]]:
    return [(layer, table) for (layer, table) in C.TABLES if store.exists(layer, table)]


def audit(store: LayerStore, scan: bool = True) -> DataFrame:
    """``(layer, table, metric, value)``: the row count of every stored
    table's current version (the runner's verification block).

    The counts come from the files (Parquet footers hold them), so they find
    what a writer got wrong.  scan=False gives the numbers that the writes
    logged instead.
    """
    spark = store.spark
    parts = []
    for layer, table in _stored(store):
        if scan:
            value = store.read(layer, table).agg(F.count(F.lit(1)).alias("value"))
        else:
            log = store.log(layer, table)
            cur = log.agg(F.max("version").alias("cur"))
            value = (log.join(cur, F.col("version") == F.col("cur"))
                        .agg(F.sum("rows").alias("value")))
        parts.append(value.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"),
                                  F.lit("rows").alias("metric"), F.col("value").cast("bigint")))
    if not parts:
        return spark.createDataFrame([], "layer string, table string, metric string, value bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contract_report(store: LayerStore) -> DataFrame:
    """``(layer, table, schema_ok, rows, null_keys, duplicate_keys)`` for
    every stored keyed table: the checks that replace primary keys."""
    spark = store.spark
    parts = []
    for layer, table in _stored(store):
        keys = C.keys_of(layer, table)
        if not keys:
            continue
        df = store.read(layer, table)
        # the types the files hold (``read`` conforms them to the contract)
        files = store.spark.createDataFrame([], store.file_schema(layer, table))
        ok = not check_contract(files, C.schema_of(layer, table))
        parts.append(check_keys(df, keys).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table"),
            F.lit(ok).alias("schema_ok"), "rows", "null_keys", "duplicate_keys"))
    if not parts:
        return spark.createDataFrame(
            [], "layer string, table string, schema_ok boolean, rows bigint, "
                "null_keys bigint, duplicate_keys bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(raw: DataFrame, stored: DataFrame, rejected: DataFrame | None, key: str, order: list[str],
              columns: list[str]) -> DataFrame:
    """Proof that every raw row is accounted for: ``(part, rows, checksum)``.

    ``raw`` is every delivered row, cleaned as it would be stored; ``stored``
    keeps the latest row per ``key`` by ``order`` (NULLs last), ``rejected`` all
    rows without a key.  Rows are compared by a hash of ``columns``, whatever
    their order.  Parts ``raw``, ``stored``, ``superseded`` and ``rejected``
    carry rows and the sum of their hashes, and raw is the sum of the other
    three if all of these faults count 0:

    * ``lost``: keys delivered but not stored; ``doubled``: surplus stored rows
      of a key; ``foreign``: stored rows that were never delivered (or were
      altered); ``stale``: keys for which an earlier row is stored;
    * ``unkeyed``: rows without a key that are rejected too few or too many
      times.

    Plan: equal rows of all three are counted together (partially map-side, so
    a hot key or a third of all rows without one is counted where it lies),
    then per key, then once.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias("k"), F.struct(*order).alias("at"), row_hash(columns).alias("h"),
                         *[F.lit(int(n == name)).cast("bigint").alias(n) for n in ("raw", "stored", "rejected")])

    sides = side(raw, "raw").unionByName(side(stored, "stored"))
    if rejected is not None:
        sides = sides.unionByName(side(rejected, "rejected"))
    rows = sides.groupBy("k", "at", "h").agg(*[F.sum(n).alias(n) for n in ("raw", "stored", "rejected")])

    def total(n: str):
        return F.sum(F.col(n).cast("decimal(15,0)") * F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)")

    per_key = rows.groupBy("k").agg(
        *[F.sum(n).alias(n) for n in ("raw", "stored", "rejected")],
        *[total(n).alias(f"{n}_sum") for n in ("raw", "stored", "rejected")],
        F.max(F.when(F.col("raw") > 0, F.col("at"))).alias("newest"),
        F.max(F.when(F.col("stored") > 0, F.col("at"))).alias("kept"),
        F.sum(F.greatest(F.col("stored") - F.col("raw"), F.lit(0))).alias("foreign"),
        F.sum(F.abs(F.col("raw") - F.col("rejected") - F.col("stored"))).alias("off"))
    keyed = F.col("k").isNotNull()
    zero = F.lit(0).cast("bigint")
    faults = {
        "lost": F.when(keyed & (F.col("raw") > 0) & (F.col("stored") == 0), 1),
        "doubled": F.when(keyed, F.greatest(F.col("stored") - 1, zero)),
        "foreign": F.when(keyed, F.col("foreign") + F.col("rejected")),
        "stale": F.when(keyed & (F.col("stored") > 0) & ~F.col("newest").eqNullSafe(F.col("kept")), 1),
        "unkeyed": F.when(~keyed, F.col("off") + F.col("stored")),
    }
    def whole(c, dtype: str):
        return F.coalesce(F.sum(c), F.lit(0)).cast(dtype)

    one = per_key.agg(*[whole(F.col(n), "bigint").alias(n) for n in ("raw", "stored", "rejected")],
                      *[whole(F.col(f"{n}_sum"), "decimal(38,0)").alias(f"{n}_sum")
                        for n in ("raw", "stored", "rejected")],
                      whole(F.when(keyed, F.col("raw") - F.col("stored")), "bigint").alias("superseded"),
                      whole(F.when(keyed, F.col("raw_sum") - F.col("stored_sum")), "decimal(38,0)").alias("superseded_sum"),
                      *[whole(c, "bigint").alias(f"fault_{n}") for n, c in faults.items()])
    parts = [F.struct(F.lit(n).alias("part"), F.col(n).alias("rows"), F.col(f"{n}_sum").alias("checksum"))
             for n in ("raw", "stored", "superseded", "rejected")]
    parts += [F.struct(F.lit(n).alias("part"), F.col(f"fault_{n}").alias("rows"),
                       F.lit(None).cast("decimal(38,0)").alias("checksum")) for n in faults]
    return one.select(F.inline(F.array(*parts)))


def reconcile_clicks(store: LayerStore) -> DataFrame:
    """``reconcile`` of bronze.click_events with the silver tables built from
    it (the load stamp of silver is left out: it is not the delivery's)."""
    columns = [c for c in C.SILVER_CLICKS.fieldNames() if c != "_processed_at"]
    return reconcile(silver.clicks(store.read("bronze", "click_events"), dedup=False),
                     store.read("silver", "click_events"), store.read("silver", "click_events_rejected"),
                     "event_id", silver.DEDUP_ORDER_CLICKS, columns)
