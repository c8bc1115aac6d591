"""What changed between two snapshots of one table.

Rows of both snapshots are hashed where they are scanned; the shuffle carries
the key, the columns asked for and the hash, and equal rows cancel out in one
aggregation.  No side is joined to the other, so a repeated or NULL key costs
no more than any other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_H1, _H2, _N = "__tf_h1", "__tf_h2", "__tf_n"


def row_hash(columns: list[str], seed: int = 0) -> Column:
    """64-bit hash of the columns, which tells a NULL from an absent value
    (plain ``xxhash64`` skips NULLs, so (NULL, x) would equal (x, NULL))."""
    return F.xxhash64(F.lit(seed), *[e for c in columns for e in (F.col(c), F.col(c).isNull())])


def changed_rows(old: DataFrame, new: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns and ``n`` of every row that only one snapshot holds:
    ``n`` > 0 counts copies that appeared, ``n`` < 0 copies that vanished.  A
    changed row gives one of each.  Both frames must have the same columns;
    rows are compared as multisets, by 128 bits of hash."""
    columns = old.columns
    if new.columns != columns:
        raise ValueError(f"snapshots differ in columns: {columns} and {new.columns}")

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*carry, row_hash(columns).alias(_H1), row_hash(columns, 1).alias(_H2),
                         F.lit(sign).alias(_N))

    both = side(new, 1).unionByName(side(old, -1))
    return (both.groupBy(*carry, _H1, _H2).agg(F.sum(_N).alias("n"))
            .where("n <> 0").select(*carry, "n"))


def changed_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``op`` of every key whose rows differ: ``insert`` (rows
    only appeared), ``delete`` (rows only vanished) or ``update``."""
    n = F.col("n")
    rows = changed_rows(old, new, keys).groupBy(*keys).agg(
        F.max(n > 0).alias("__more"), F.max(n < 0).alias("__less"))
    op = (F.when(F.col("__more") & F.col("__less"), "update")
          .when(F.col("__more"), "insert").otherwise("delete"))
    return rows.select(*keys, op.alias("op"))
