"""Intermediate tables of multi-job operators.

An operator that needs a result more than once writes it as Parquet under
the shared checkpoint folder and reads it back: the lineage ends there, so a
lost executor costs at most the job that runs, and statistics of the written
files tell the planner which sides are small.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tierflow.session import scratch_path


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh scratch table and return the reader of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path, compression=compression)
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs now; it
    acts on what the driver's collector finds unreachable."""
    gc.collect()
    spark._jvm.java.lang.System.gc()
