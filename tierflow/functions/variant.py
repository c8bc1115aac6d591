"""Open metadata as VARIANT (K8, K9, A1): any path of it, and a report of the
paths present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, json: str = "metadata_json", name: str = "metadata") -> DataFrame:
    """Add the JSON text of column ``json`` as VARIANT ``name``, parsed once.
    NULL and text that is no JSON give NULL."""
    return df.withColumn(name, F.try_parse_json(F.col(json)))


def at(variant: str, path: str, dtype: str = "string") -> Column:
    """The value at a JSON path (``$.a.b``, ``$.tags[1]``) of a VARIANT column
    as ``dtype``.  An absent path, a JSON null, and a value that is not of the
    type (nor can be cast to it) give NULL."""
    return F.try_variant_get(F.col(variant), path, dtype)


def path_report(df: DataFrame, variant: str = "metadata", depth: int = 2) -> DataFrame:
    """``(path, rows, type)`` of every path up to ``depth`` steps deep that any
    row holds: ``$.key`` for a member of an object, ``[*]`` for the elements of
    an array.  ``rows`` counts the values met there (each element of an array),
    ``type`` is the least type that holds all of them (``VARIANT`` where they
    have none in common).

    Each step is a Generate over the values of the step before; types and
    counts are merged map-side, so the shuffle moves a row per path and task.
    """
    spark = df.sparkSession
    level = df.select(F.lit("$").alias("path"), F.col(variant).alias("__v")).where("__v IS NOT NULL")
    found = None
    for _ in range(depth):
        level = level.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer())).select(
            F.concat("path", F.when(F.col("key").isNull(), "[*]").otherwise(F.concat(F.lit("."), "key"))).alias("path"),
            F.col("value").alias("__v"))
        found = level if found is None else found.unionByName(level)
    return found.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("__v").alias("type"))
