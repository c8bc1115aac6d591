"""JDBC source and sink.

Spark's own JDBC data source does the work; this module only builds the
options a production read/write needs.  Credentials come from the
environment, never from code or config files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.session import env


def connection(url_env: str = "JDBC_URL", user_env: str = "JDBC_USER",
               password_env: str = "JDBC_PASSWORD", driver: str | None = None) -> dict:
    """Connection options read from environment variables."""
    opts = {"url": env(url_env), "user": env(user_env), "password": env(password_env)}
    if driver:
        opts["driver"] = driver
    return opts


def read_options(conn: dict, table: str, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict:
    """Options for a parallel read.

    Without bounds a JDBC read is a single partition (one task, one
    connection).  With a numeric/date ``partition_column`` and bounds, Spark
    issues ``num_partitions`` range queries in parallel; rows outside the
    bounds still land in the first/last partition, so nothing is lost.
    """
    opts = dict(conn, dbtable=table, fetchsize=str(fetch_size))
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC reads need lower/upper bounds and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_by_predicates(spark: SparkSession, conn: dict, table: str,
                       predicates: list[str], fetch_size: int = 10_000) -> DataFrame:
    """A parallel read with one task per WHERE-clause predicate (for tables
    without a numeric split column, e.g. one predicate per month).  The
    predicates must not overlap and should cover every row."""
    props = {k: v for k, v in conn.items() if k != "url"}
    props["fetchsize"] = str(fetch_size)
    return spark.read.jdbc(conn["url"], table, predicates=predicates, properties=props)


def read(spark: SparkSession, conn: dict, table: str, **kw) -> DataFrame:
    """A (bounded, parallel) JDBC table scan; filters and column pruning are
    pushed into the generated SQL by Spark."""
    return spark.read.format("jdbc").options(**read_options(conn, table, **kw)).load()


def write_options(conn: dict, table: str, mode: str = "append",
                  batch_size: int = 10_000, num_partitions: int | None = None,
                  truncate: bool = True) -> dict:
    """Options for a batched write.

    ``truncate`` matters for ``overwrite``: without it Spark drops and
    re-creates the table, losing keys and indexes declared by the DDL.
    ``num_partitions`` caps concurrent connections (Spark coalesces).
    """
    opts = dict(conn, dbtable=table, batchsize=str(batch_size))
    if mode == "overwrite":
        opts["truncate"] = "true" if truncate else "false"
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts


def check_writable(df: DataFrame) -> None:
    """JDBC has no struct/map/array type: fail before connecting, naming
    the columns (serialise them with ``to_json`` first, as bronze does for
    ``metadata``)."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))]
    if nested:
        raise ValueError(f"columns {nested} are nested; serialise them (to_json) before a JDBC write")


def write(df: DataFrame, conn: dict, table: str, mode: str = "append", **kw) -> None:
    """Append or replace a JDBC table (nested columns are refused)."""
    check_writable(df)
    (df.write.format("jdbc").mode(mode)
       .options(**write_options(conn, table, mode=mode, **kw)).save())
