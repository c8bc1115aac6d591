"""Latest version per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__tf_rn"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   tie_break: bool = True, null_keys: str = "keep",
                   tie_columns: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the greatest ``order`` tuple, NULLs last.

    Plan: ``row_number() = 1`` becomes a *partial* WindowGroupLimit before
    the shuffle on ``keys`` and a final one after it, so a hot key (for
    example every row with a NULL key) is cut to one row per map partition
    before anything moves: no single task ever receives the whole group.

    tie_break: rows equal on every ``order`` column are ranked by a hash of
        the whole row, so the survivor does not depend on task timing.
    tie_columns: the columns of that hash, in order (default: all).  Without
        the columns of a layout, the survivor does not depend on it either.
    null_keys: "keep" (rows with a NULL key form one group, like the
        original job) or "reject" (fail the job on a NULL key).
    """
    if null_keys not in ("keep", "reject"):
        raise ValueError("null_keys must be 'keep' or 'reject'")
    if null_keys == "reject":
        df = df.withColumns({
            k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"NULL key in {k}")))
                .otherwise(F.col(k))
            for k in keys})
    ords: list[Column] = [F.col(c).desc_nulls_last() for c in order]
    if tie_break:
        # maps cannot be hashed directly; their JSON text can
        cols = [F.to_json(F.col(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
                for f in ([df.schema[c] for c in tie_columns] if tie_columns else df.schema.fields)]
        ords.append(F.xxhash64(*cols).desc())
    w = Window.partitionBy(*keys).orderBy(*ords)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
