"""One feed whose files have several shapes.

Files of a feed change over the years: columns come and go, and one column is
a number here and text there.  ``fields`` names every column wanted with its
type; a file that lacks one gives its typed default, and a value of another
type is converted where it can be.  What can't be is NULL, and its column is
named in ``_conflicts`` instead of failing the job or vanishing silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.clean import to_utc_ntz, typed_null
from tierflow.sources.jsonl import MALFORMED, with_malformed

CONFLICTS = "_conflicts"


def _typed(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    have = df.schema[name].dataType
    if have == dtype:
        return F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        if isinstance(have, (T.StringType, T.DateType, T.TimestampType)):
            return to_utc_ntz(df, name)
        return typed_null(dtype)                    # a number names no time
    if isinstance(dtype, T.StringType):
        return F.col(name).cast("string")
    if isinstance(dtype, T.IntegralType) and not isinstance(have, T.IntegralType):
        # text or a fraction is an integer only if nothing of it is lost
        exact = F.col(name).try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact.try_cast(dtype))
    return F.col(name).try_cast(dtype)


def align(df: DataFrame, fields: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """``df`` with the columns and types of ``fields``, and ``_conflicts``: the
    names of those whose value there is could not be given the type (an empty
    array where none).  A column that ``df`` lacks, and a NULL, become the
    default of that name, or NULL.  Other columns are dropped."""
    defaults = defaults or {}
    out, bad = [], []
    for f in fields.fields:
        default = F.lit(defaults.get(f.name)).cast(f.dataType)
        if f.name not in df.columns:
            out.append(default.alias(f.name))
            continue
        value = _typed(df, f.name, f.dataType)
        given = F.col(f.name).isNotNull()
        out.append((F.when(~given, default).otherwise(value) if f.name in defaults else value).alias(f.name))
        bad.append(F.when(given & value.isNull(), F.lit(f.name)))
    conflicts = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return df.select(*out, conflicts.alias(CONFLICTS))


def read_lines(spark: SparkSession, path: str, fields: T.StructType,
               defaults: dict[str, object] | None = None) -> DataFrame:
    """JSON lines of any mix of shapes in one scan: every field is read as its
    text, whatever JSON type it has, and aligned.  No file is read to infer a
    schema.  A line that is no JSON keeps its text in ``_malformed``."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields.fields])
    read = with_malformed(spark.read, texts).json(path)
    kept = align(read.select(*texts.fieldNames(), MALFORMED),
                 T.StructType([*fields.fields, T.StructField(MALFORMED, T.StringType())]), defaults)
    return kept.select(*fields.fieldNames(), CONFLICTS, MALFORMED)


def union_shapes(frames: list[DataFrame], fields: T.StructType,
                 defaults: dict[str, object] | None = None) -> DataFrame:
    """Frames of typed files (Parquet, JDBC), one a shape, as one feed: each is
    scanned once, and only for the fields it has."""
    return reduce(DataFrame.unionByName, [align(f, fields, defaults) for f in frames])
