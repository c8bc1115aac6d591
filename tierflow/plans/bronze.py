"""Bronze: land raw data as it came, with a load stamp (L1, L2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import contracts as C
from tierflow.functions.clean import load_stamp, parse_instant, struct_to_json
from tierflow.sources.jsonl import MALFORMED

RAW_CLICK_COLUMNS = ["event_id", "user_id", "session_id", "event_type",
                     "page", "route", "element", "ts", "metadata"]


def _stamp(df: DataFrame, run_ts) -> DataFrame:
    """``_ingested_at`` is never NULL (the table default is the load time):
    keep a delivery time the landing process stamped, else the load stamp."""
    if "_ingested_at" in df.columns:
        return df.withColumn("_ingested_at",
                             F.coalesce(F.col("_ingested_at").cast("timestamp_ntz"),
                                        load_stamp(run_ts)))
    return df.withColumn("_ingested_at", load_stamp(run_ts))


def orders(oltp_orders: DataFrame, run_ts=None) -> DataFrame:
    """Snapshot of the OLTP orders table plus ``_ingested_at``."""
    return C.conform(_stamp(oltp_orders, run_ts), C.BRONZE_ORDERS)


def _metadata_text(raw: DataFrame) -> Column:
    """``metadata`` as JSON text: a struct is written as JSON, text is kept.
    The text of a malformed line is added as one more attribute, so that it
    reaches silver, or the rejected rows if the line has no event_id."""
    is_text = isinstance(raw.schema["metadata"].dataType, T.StringType)
    text = F.col("metadata") if is_text else struct_to_json("metadata")
    if MALFORMED not in raw.columns:
        return text
    line = F.to_json(F.struct(F.col(MALFORMED)))
    both = F.concat(F.substr(line, F.lit(1), F.length(line) - 1), F.lit(","), F.substr(text, F.lit(2)))
    return F.when(F.col(MALFORMED).isNull(), text).when(text.rlike(r'^\{\s*"'), both).otherwise(line)


def clicks(raw: DataFrame, run_ts=None, parse: bool = True) -> DataFrame:
    """Raw click records -> bronze.click_events.

    parse=True (the bronze job): ``ts`` text -> UTC timestamp, ``metadata``
    (JSON text or a struct) -> ``metadata_json`` text with every key it has.  parse=False (the raw loader):
    raw ``ts`` and the nested ``metadata`` kept as they are; only fit for a
    sink that stores structs (parquet, not JDBC).
    """
    df = _stamp(raw.select(*RAW_CLICK_COLUMNS, *(c for c in ("_ingested_at", MALFORMED) if c in raw.columns)),
                run_ts)
    if not parse:
        return df.select(*RAW_CLICK_COLUMNS, "_ingested_at")
    return C.conform(
        df.withColumns({"ts": parse_instant("ts"),
                        "metadata_json": _metadata_text(df)}).drop("metadata", MALFORMED),
        C.BRONZE_CLICKS)
