"""JSON-lines click files (A1, and the raw loader's input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import types as T

from tierflow import contracts as C

DEFAULT_PATH_ENV = "CLICKSTREAM_PATH"
#: Text of a line that is not (wholly) of the schema; NULL for all others.
MALFORMED = "_malformed"


def with_malformed(reader, schema: T.StructType):
    """A JSON reader that keeps the text of lines it can't parse."""
    return (reader.schema(T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED))


def read_clicks(spark: SparkSession, path: str, schema=C.RAW_CLICK) -> DataFrame:
    """Read newline-delimited JSON with an explicit schema.

    An explicit schema avoids the inference pass over every file (one scan
    instead of two) and keeps types stable across batches; ``metadata`` stays
    JSON text.  A malformed line keeps its row: NULL fields (or one NULL field,
    where a value is of another type), and its text in ``_malformed``.
    """
    return with_malformed(spark.read, schema).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a frame as JSON lines (NULL fields are omitted, like the
    files the collector produces)."""
    df.write.mode(mode).option("compression", "none").json(path)
