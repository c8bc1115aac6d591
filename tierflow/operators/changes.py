"""Apply a set of item changes to a snapshot in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.clean import load_stamp
from tierflow.session import ensure_checkpoint_dir

FIELDS = ["name", "sku", "quantity", "location"]


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Number rows 1..n in ``order`` without a single-partition window.

    The frame is range-partitioned and sorted on ``order`` and written to
    the checkpoint folder (so the numbering is stable if a task is retried),
    then each partition's row count gives its offset.  Only the per-partition
    counts -- one row per partition, a size bounded by the partition count --
    are broadcast.  ``order`` must be unique.
    """
    pid, mono = "__tf_pid", "__tf_mono"
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn(pid, F.spark_partition_id())
                 .withColumn(mono, F.monotonically_increasing_id())
                 .checkpoint(eager=True))
    counts = ordered.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"),
                                      F.min(mono).alias("__first"))
    # one row per partition: a global window here is over a bounded table
    offsets = counts.withColumn(
        "__off", F.sum("__n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select(pid, "__first", F.coalesce("__off", F.lit(0)).alias("__off"))
    return (ordered.join(F.broadcast(offsets), pid)
                   .withColumn(name, F.col("__off") + (F.col(mono) - F.col("__first")) + 1)
                   .drop(pid, mono, "__first", "__off"))


def apply_changes(snapshot: DataFrame, changes: DataFrame,
                  run_ts=None, id_floor: int | None = None) -> DataFrame:
    """Apply create/update/delete rows (``seq, op, id, name, sku, quantity,
    location``) to an item snapshot (``id, name, sku, quantity, location,
    updated_at``).

    Several changes to one id resolve as if applied in ``seq`` order:
    * any delete removes the row, even if an update follows (the update then
      finds nothing);
    * otherwise the update with the highest seq wins whole -- each update
      replaces all four fields, NULLs included -- and stamps ``updated_at``;
    * updates/deletes of unknown ids change nothing;
    * a create gets a new id = max(existing id, ``id_floor``) + its rank
      among creates by seq, so ids are never reused when ``id_floor`` is
      the highest id ever assigned (``runner.apply_item_changes`` keeps it);
      a create that carries an id is rejected (see ``items.validity``);
    * ids of creates are assigned while the set is applied, so updates and
      deletes in the same set can only refer to ids already in the snapshot.

    Plan: the change set is reduced to one row per id (partial aggregation
    runs map-side, so a hot id costs one row per partition) and joined once
    to the snapshot.  AQE broadcasts the reduced changes when they are
    measured small; otherwise the snapshot is shuffled once on id.
    """
    stamp = load_stamp(run_ts)
    op = F.lower(F.trim("op"))
    keyed = changes.where(op.isin("update", "delete") & F.col("id").isNotNull())
    upd_seq = F.when(op == "update", F.col("seq"))
    per_id = (keyed.groupBy("id").agg(
        F.max(op == "delete").alias("__deleted"),
        F.max(upd_seq).alias("__upd_seq"),
        F.max_by(F.struct(*FIELDS), upd_seq).alias("__upd")))

    s = snapshot.alias("s")
    joined = s.join(per_id.alias("c"), F.col("s.id") == F.col("c.id"), "left")
    updated = F.col("c.__upd_seq").isNotNull()
    cols: list[Column] = [F.col("s.id").alias("id")]
    cols += [F.when(updated, F.col(f"c.__upd.{f}")).otherwise(F.col(f"s.{f}")).alias(f)
             for f in FIELDS]
    cols.append(F.when(updated, stamp).otherwise(F.col("s.updated_at")).alias("updated_at"))
    kept = joined.where(F.col("c.__deleted").isNull() | ~F.col("c.__deleted")).select(*cols)

    creates = changes.where((op == "create") & F.col("id").isNull())
    base = F.coalesce(snapshot.select(F.max("id")).scalar(), F.lit(0))
    if id_floor is not None:
        base = F.greatest(base, F.lit(id_floor).cast("bigint"))
    numbered = dense_index(creates.select("seq", *FIELDS), ["seq"], "__rank")
    new_rows = numbered.select((base + F.col("__rank")).cast("bigint").alias("id"),
                               *FIELDS, stamp.alias("updated_at"))
    return kept.unionByName(new_rows.select(*kept.columns))
