"""Item rules from the stock page and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------
LOW_STOCK_THRESHOLD = 5          # a row is highlighted when quantity < 5
REQUIRED_FIELDS = ("name", "sku", "quantity", "location")
# -------------------------------------------------------------------------


def low_stock(items: DataFrame, threshold: int = LOW_STOCK_THRESHOLD) -> DataFrame:
    """Add ``low_stock``; a NULL quantity is *not* low (SQL semantics)."""
    return items.withColumn("low_stock",
                            F.coalesce(F.col("quantity") < F.lit(threshold), F.lit(False)))


def _blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def validity(changes: DataFrame) -> DataFrame:
    """One row per change with ``valid`` and the first failing ``reason``.

    create/update need all four fields present and non-empty and a quantity
    >= 0 (zero is valid); a create must not carry an id; update/delete need
    an id; any other op is invalid.
    """
    op = F.lower(F.trim("op"))
    needs_fields = op.isin("create", "update")
    reason = (F.when(~op.isin("create", "update", "delete") | op.isNull(), F.lit("unknown_op"))
               .when((op == "create") & F.col("id").isNotNull(), F.lit("create_with_id"))
               .when(op.isin("update", "delete") & F.col("id").isNull(), F.lit("missing_id")))
    for f in REQUIRED_FIELDS:
        reason = reason.when(needs_fields & _blank(F.col(f)), F.lit(f"missing_{f}"))
    reason = reason.when(needs_fields & (F.col("quantity") < 0), F.lit("negative_quantity"))
    return changes.select("seq", "op", "id", reason.alias("reason")).select(
        "seq", "op", "id", F.col("reason").isNull().alias("valid"), "reason")


def lookup(items: DataFrame, wanted_ids: DataFrame, key: str = "id") -> DataFrame:
    """D3: rows whose key is in ``wanted_ids`` (a left-semi join: each item
    is returned once however often its id is asked for)."""
    return items.join(wanted_ids.select(F.col(key)), on=key, how="left_semi")
