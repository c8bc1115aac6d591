"""Keyed upsert (J1, J2): insert new keys, replace matched rows whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """Raised when a frame that must be keyed has NULL or repeated keys."""


def check_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Fail loudly when ``keys`` are NULL or repeated in ``df``.

    One aggregation over the key columns only (partial counts are combined
    map-side); at most one offending key comes back to the driver.
    """
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    bad = (df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) | null_any).limit(1).collect())
    if bad:
        raise KeyViolation(f"{what} has a NULL or repeated key: {bad[0].asDict()}")


def checked_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of ``source``; evaluating the frame fails the job if
    a key is NULL or repeated.  The check is part of the plan (no extra pass
    over the source): the per-key count is a partial + final aggregate."""
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    bad = (F.col("__n") > 1) | null_any
    msg = F.concat(F.lit("upsert source has a NULL or repeated key: "),
                   F.to_json(F.struct(*[F.col(k) for k in keys])))
    # The check is a projection of the key that depends on the count, so
    # the "key IS NOT NULL" filter the optimizer infers from the join cannot
    # be pushed below it (a filter here would let NULL keys slip away).
    return (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                  .select(*[F.when(bad, F.raise_error(msg)).otherwise(F.col(k)).alias(k)
                            for k in keys]))


def checked_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` itself; evaluating it fails the job if a key is NULL or
    repeated, whatever else the plan does with its keys."""
    rows = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                     F.first(F.struct(*(c for c in source.columns if c not in keys))).alias("__row"))
    bad = F.col("__n") > 1
    for k in keys:
        bad = bad | F.col(k).isNull()
    msg = F.concat(F.lit("upsert source has a NULL or repeated key: "), F.to_json(F.struct(*keys)))
    # a filter on the count: neither pruned with columns nor pushed below
    ok = rows.where(F.when(bad, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    return ok.select(*keys, "__row.*").select(*source.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           check_source: bool = True) -> DataFrame:
    """``source`` rows win whole (NULLs included); unmatched target rows stay.

    Equivalent to ``INSERT ... ON DUPLICATE KEY UPDATE`` that assigns every
    non-key column.  A full outer join with per-column coalesce would be
    wrong: it would keep target values where the source has NULLs.

    check_source: the source must be keyed (no NULL, no repeated key); the
        check runs inside the same job (see ``checked_keys``) and fails it.

    Plan: left-anti join of the target against the source *keys only*, then
    a union.  AQE broadcasts the key set when its measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise both sides
    are hash-partitioned on the key once (sort-merge).  The target is never
    collected or broadcast.
    """
    src = source.select(*target.columns)
    if check_source and set(target.columns) > set(keys):
        src = checked_rows(src, keys)
    src_keys = checked_keys(source, keys) if check_source else source.select(*keys)
    kept = target.join(src_keys, on=keys, how="left_anti")
    return src.unionByName(kept)


def merge_buckets(target: DataFrame, source: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``upsert`` into a target that is stored in ``buckets`` buckets of its
    key: the join runs bucket by bucket.

    The source is dealt by its key once; that one exchange serves the key
    check (a count over the key) and the join, and leaves the rows as the next
    version is stored.  The target has no exchange: its buckets are read as
    they lie.  A key that is NULL or repeated in the source fails the job.
    """
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    msg = F.concat(F.lit("upsert source has a NULL or repeated key: "), F.to_json(F.struct(*keys)))
    dealt = source.select(*target.columns).repartition(buckets, *keys)
    counted = dealt.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    new = counted.select(*target.columns, F.when((F.col("__n") > 1) | null_any, F.raise_error(msg).cast("boolean"))
                         .otherwise(F.lit(True)).alias("__new")).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return target.alias("t").join(new, on, "full_outer").select(
        *[F.when(F.col("s.__new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])
