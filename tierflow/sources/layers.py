"""Layer tables on a shared file system.

A table lives at ``<root>/<layer>/<table>/``.  Each full write creates a
new version folder ``v000001/ v000002/ ...`` and then appends one row to
the table's commit log ``_log/`` (a small parquet table: version, rows
added, committed_at, and where relevant the stream epoch, the load
sequence number, the last source load merged and the highest generated
id).  Readers take the highest committed version, so

* a job may read a table and write its next version (an upsert) without
  overwriting files it is still reading;
* a job that dies before the commit row leaves the current version intact,
  and a re-run gives the same result.

Appends (bronze clicks, rejected rows) go into the current version instead,
each load into its own folder: readers take the folders of committed loads,
and a load that was stopped before its commit is written anew by the next.

Keyed upserts into a partitioned table (``upsert``) rewrite only the
partitions that hold a key of the source now or will hold one afterwards,
in place (dynamic partition overwrite), and log the change in row count.
An upsert is idempotent, so a run interrupted between partition commits
converges when re-run.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tierflow import contracts as C
from tierflow.operators.dedup import latest_per_key
from tierflow.operators.upsert import checked_keys, checked_rows, merge_buckets


def observed(obs: Observation, name: str = "n") -> int:
    """An observed count, read after the action that computed it.

    When the optimizer proves the observed input empty (for example a
    partition filter that matches no folder) it removes the observing node
    and no metrics are reported: no row passed, so the count is 0.
    """
    try:
        value = obs.get.get(name)
    except Exception:          # metrics never reported: node pruned as empty
        return 0
    return 0 if value is None else int(value)


@dataclass
class UpsertResult:
    delta: int                        # change in row count
    touched: list[dict] | None        # partitions rewritten; None = whole table


class LayerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # commit-log rows per table, read once and kept current by _commit
        # (one writer per table; refresh() picks up other writers' commits)
        self._logs: dict[tuple[str, str], list[dict]] = {}

    def refresh(self) -> None:
        """Forget cached commit logs (re-read them on next use)."""
        self._logs.clear()

    def _log_rows(self, layer: str, table: str) -> list[dict]:
        key = (layer, table)
        if key not in self._logs:
            log = self.log(layer, table)
            # one small row per commit: a bounded read
            self._logs[key] = [] if log is None else [r.asDict() for r in log.collect()]
        return self._logs[key]

    # ---- locations ------------------------------------------------------
    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _log_path(self, layer: str, table: str) -> str:
        return f"{self.table_path(layer, table)}/_log"

    def _version_path(self, layer: str, table: str, version: int) -> str:
        return f"{self.table_path(layer, table)}/v{version:06d}"

    # ---- metadata -------------------------------------------------------
    def _exists(self, path: str) -> bool:
        """File-system existence check (any Hadoop-compatible store)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _delete_uri(self, uri: str) -> None:
        """Delete a folder named by a URI, where names are escaped."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri))
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True):
            raise FileNotFoundError(f"no folder to delete at {uri}")

    def _children(self, path: str) -> list[str]:
        """Names of the entries of a folder ([] if it does not exist)."""
        if not self._exists(path):
            return []
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [st.getPath().getName() for st in fs.listStatus(p)]

    def _snapshot(self, layer: str, table: str) -> int:
        """Highest commit sequence number folded into a log snapshot (0: none)."""
        snaps = [int(n[1:]) for n in self._children(f"{self.table_path(layer, table)}/_logsnap")
                 if n.startswith("s") and n[1:].isdigit()]
        return max(snaps, default=0)

    def log(self, layer: str, table: str) -> DataFrame | None:
        """All commit entries: the newest snapshot plus the entries after it."""
        snap = self._snapshot(layer, table)
        parts = []
        if snap:
            parts.append(self.spark.read.parquet(
                f"{self.table_path(layer, table)}/_logsnap/s{snap:08d}"))
        path = self._log_path(layer, table)
        if any(n.endswith(".parquet") for n in self._children(path)):
            try:
                tail = self.spark.read.parquet(path)
                parts.append(tail.where(F.col("seq") > F.lit(snap)) if snap else tail)
            except AnalysisException:
                pass
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def compact_log(self, layer: str, table: str) -> int:
        """Fold a table's commit entries into one snapshot file and remove the
        per-commit files; returns the entries folded.  Safe to interrupt:
        readers take the newest snapshot plus entries with a higher ``seq``,
        so a crash between the steps never counts an entry twice."""
        self._logs.pop((layer, table), None)     # fold what is on disk (with commit times)
        rows = self._log_rows(layer, table)
        if not rows:
            return 0
        top = max(r["seq"] for r in rows)
        root = self.table_path(layer, table)
        old_snaps = self._children(f"{root}/_logsnap")
        old_files = self._children(self._log_path(layer, table))
        schema = self.log(layer, table).schema
        (self.spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows],
                                    schema)
             .coalesce(1).write.mode("overwrite").parquet(f"{root}/_logsnap/s{top:08d}"))
        for name in old_files:
            self._delete(f"{self._log_path(layer, table)}/{name}")
        for name in old_snaps:
            if name != f"s{top:08d}":
                self._delete(f"{root}/_logsnap/{name}")
        return len(rows)

    def current_version(self, layer: str, table: str) -> int | None:
        return self._log_max(layer, table, "version")

    def _log_max(self, layer: str, table: str, column: str) -> int | None:
        vals = [r.get(column) for r in self._log_rows(layer, table)]
        vals = [v for v in vals if v is not None]
        return int(max(vals)) if vals else None

    def id_high(self, layer: str, table: str) -> int | None:
        """Highest generated id ever committed to a table."""
        return self._log_max(layer, table, "id_high")

    def last_load_seq(self, layer: str, table: str) -> int | None:
        """Sequence number of the latest load into a sequenced table."""
        return self._log_max(layer, table, "load_seq")

    def source_seq(self, layer: str, table: str) -> int | None:
        """Highest source load merged into this table (None: none yet)."""
        return self._log_max(layer, table, "source_seq")

    def last_commit(self, layer: str, table: str) -> int | None:
        """Number of a table's latest commit."""
        return self._log_max(layer, table, "seq")

    def has_load(self, layer: str, table: str, load_id: str) -> bool:
        """Whether a load of that id is committed."""
        return any(r.get("load_id") == load_id for r in self._log_rows(layer, table))

    def last_epoch(self, layer: str, table: str) -> int:
        """Highest stream epoch committed to a table (-1 if none)."""
        v = self._log_max(layer, table, "epoch")
        return -1 if v is None else v

    def exists(self, layer: str, table: str) -> bool:
        return self.current_version(layer, table) is not None

    # ---- read -----------------------------------------------------------
    def read(self, layer: str, table: str, raw: bool = False) -> DataFrame:
        """The current version; a table never written reads as empty with
        its contract schema (so a first upsert starts from nothing).
        raw=True keeps storage partition columns (for partition pruning)."""
        v = self.current_version(layer, table)
        schema = C.schema_of(layer, table) if (layer, table) in C.TABLES else None
        if v is None:
            if schema is None:
                raise FileNotFoundError(f"{layer}.{table} has never been written")
            return C.empty(self.spark, schema)
        df = self._read_version(layer, table, v)
        return C.conform(df, schema) if (schema is not None and not raw) else df

    def read_version(self, layer: str, table: str, version: int) -> DataFrame | None:
        """An earlier version of a contract table that is still kept; None if
        its folder is gone."""
        if not self._exists(self._version_path(layer, table, version)):
            return None
        return C.conform(self._read_version(layer, table, version), C.schema_of(layer, table))

    def file_schema(self, layer: str, table: str):
        """The column types the current version's files really hold (read
        from the parquet footers, storage-only columns left out): what a
        contract check must look at, since ``read`` applies the contract."""
        v = self.current_version(layer, table)
        if v is None:
            return None
        storage = set(C.TABLES.get((layer, table), (None, None, []))[2]) | {"_load_seq"}
        if not self._read_version(layer, table, v).inputFiles():
            return C.schema_of(layer, table)        # an empty partitioned table has no files
        schema = self.spark.read.parquet(self._version_path(layer, table, v)).schema
        return T.StructType([f for f in schema.fields if f.name not in storage])

    def _read_version(self, layer: str, table: str, version: int) -> DataFrame:
        """One version's files, with the declared stored schema (no
        inference) for contract tables."""
        reader = self.spark.read
        if (layer, table) in C.TABLES:
            reader = reader.schema(C.stored_schema(layer, table))
        df = reader.parquet(self._version_path(layer, table, version))
        if (layer, table) in C.LOAD_SEQUENCED:
            df = df.where(F.col("_load_seq") <= F.lit(self.last_load_seq(layer, table)))
        return df

    # ---- write ----------------------------------------------------------
    def _commit(self, layer: str, table: str, version: int, rows: int,
                epoch: int | None = None, load_seq: int | None = None,
                source_seq: int | None = None, id_high: int | None = None,
                load_id: str | None = None) -> None:
        """Append one row to the table's commit log.  load_seq: sequence
        number of this load (sequenced tables); source_seq: highest load of
        the source table merged into this table so far."""
        rows_cache = self._log_rows(layer, table)
        seq = max((r.get("seq") or 0 for r in rows_cache), default=0) + 1
        entry = self.spark.range(1).select(
            F.lit(seq).cast("bigint").alias("seq"),
            F.lit(version).cast("int").alias("version"),
            F.lit(rows).cast("bigint").alias("rows"),
            F.current_timestamp().alias("committed_at"),
            F.lit(epoch).cast("bigint").alias("epoch"),
            F.lit(load_seq).cast("bigint").alias("load_seq"),
            F.lit(source_seq).cast("bigint").alias("source_seq"),
            F.lit(id_high).cast("bigint").alias("id_high"),
            F.lit(load_id).cast("string").alias("load_id"))
        entry.coalesce(1).write.mode("append").parquet(self._log_path(layer, table))
        rows_cache.append({"seq": seq, "version": version, "rows": rows,
                           "committed_at": None, "epoch": epoch,
                           "load_seq": load_seq, "source_seq": source_seq, "id_high": id_high,
                           "load_id": load_id})

    def _layout(self, df: DataFrame, layer: str, table: str,
                partition_by: list[str] | None) -> tuple[DataFrame, list[str], list[str], bool]:
        """Add storage partition columns; return (frame, partition cols, sort
        cols, rebalance)."""
        if partition_by is None:
            partition_by = C.TABLES[(layer, table)][2] if (layer, table) in C.TABLES else []
        for p in partition_by:
            if p not in df.columns:
                df = df.withColumn(p, F.expr(C.PARTITION_EXPRS[p]))
        return (df, list(partition_by), C.SORT_WITHIN.get((layer, table), []),
                (layer, table) in C.REBALANCE_ON_WRITE)

    def _write(self, df: DataFrame, path: str, mode: str, partition_by: list[str],
               sort_by: list[str], rebalance: bool = False,
               bucket_by: tuple[list[str], int] | None = None) -> int:
        obs = Observation()
        if partition_by and rebalance:
            # REBALANCE: one shuffle on the partition columns; AQE merges
            # small output partitions and splits a skewed one (a hot day
            # does not end up in one task), so files are few and even.
            df = df.hint("rebalance", *partition_by)
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if partition_by or sort_by:
            counted = counted.sortWithinPartitions(*partition_by, *sort_by)
        w = counted.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            keys, n = bucket_by
            name = self._bucket_table(path)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            w.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name, format="parquet")
        else:
            w.parquet(path)
        return observed(obs, "rows")

    # ---- tables in buckets of their key ----------------------------------
    def _bucket_table(self, path: str) -> str:
        """Catalog name of the bucketed files of a version."""
        return f"tierflow_buckets_{zlib.crc32(path.encode()):08x}_{re.sub('[^a-z0-9]+', '_', path.lower())[-40:]}"

    def _bucket_spec(self, layer: str, table: str) -> tuple[list[str], int] | None:
        n = C.BUCKETS.get((layer, table))
        return (C.keys_of(layer, table), n) if n else None

    def read_buckets(self, layer: str, table: str) -> DataFrame | None:
        """The current version with its buckets known to the planner; None if
        its files are not in buckets (written before the table had any)."""
        cur, n = self.current_version(layer, table), C.BUCKETS.get((layer, table))
        if cur is None or n is None:
            return None
        files = self._read_version(layer, table, cur).inputFiles()
        if any(not re.search(r"_\d{5}\.c\d{3}", f) for f in files):
            return None
        path = self._version_path(layer, table, cur)
        name = self._bucket_table(path)
        text = C.ddl(layer, table, path).split(" (", 1)[1]
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({text}")
        return self.spark.table(name)

    def merged_buckets(self, source: DataFrame, layer: str, table: str) -> DataFrame | None:
        """The next version of a bucketed table after an upsert of ``source``;
        None if the current one is not in buckets."""
        target = self.read_buckets(layer, table)
        if target is None:
            return None
        keys, n = self._bucket_spec(layer, table)
        return merge_buckets(target, C.conform(source, C.schema_of(layer, table)), keys, n)

    def overwrite(self, df: DataFrame, layer: str, table: str,
                  partition_by: list[str] | None = None, epoch: int | None = None,
                  id_high: int | None = None, source_seq: int | None = None,
                  load_id: str | None = None) -> int:
        """Write ``df`` as the next version and commit it; returns row count
        (counted while writing, not by a second pass)."""
        df, parts, sort_by, rebalance = self._layout(df, layer, table, partition_by)
        cur = self.current_version(layer, table) or 0
        path, seq = self._place(layer, table, cur + 1)
        buckets = self._bucket_spec(layer, table)
        if buckets:
            df = df.repartition(buckets[1], *buckets[0])        # one file a bucket
        rows = self._write(df, path, "overwrite", parts, sort_by, rebalance, buckets)
        self._commit(layer, table, cur + 1, rows, epoch, seq, source_seq, id_high, load_id)
        return rows

    def append(self, df: DataFrame, layer: str, table: str,
               partition_by: list[str] | None = None, epoch: int | None = None,
               source_seq: int | None = None, load_id: str | None = None) -> int:
        """Append rows to the current version of a table with a folder per
        load (bronze is append-only); returns the rows appended."""
        if (layer, table) not in C.LOAD_SEQUENCED:
            raise ValueError(f"{layer}.{table} has no load folders: an append would not be atomic")
        cur = self.current_version(layer, table)
        if cur is None:
            return self.overwrite(df, layer, table, partition_by, epoch, None, source_seq, load_id)
        df, parts, sort_by, rebalance = self._layout(df, layer, table, partition_by)
        path, seq = self._place(layer, table, cur)
        rows = self._write(df, path, "overwrite", parts, sort_by, rebalance)
        self._commit(layer, table, cur, rows, epoch, seq, source_seq, None, load_id)
        return rows

    def _place(self, layer: str, table: str, version: int) -> tuple[str, int | None]:
        """Folder of the next write into a version, and the number of the load."""
        path = self._version_path(layer, table, version)
        if (layer, table) not in C.LOAD_SEQUENCED:
            return path, None
        seq = (self.last_load_seq(layer, table) or 0) + 1
        return f"{path}/_load_seq={seq}", seq

    def read_loads_after(self, layer: str, table: str, after: int | None) -> DataFrame:
        """Rows of a sequenced table written by loads after ``after`` (all
        rows when None), in the contract schema."""
        df = self.read(layer, table, raw=True)
        if after is not None and "_load_seq" in df.columns:
            df = df.where(F.col("_load_seq") > F.lit(after))
        return C.conform(df, C.schema_of(layer, table))

    def upsert(self, source: DataFrame, layer: str, table: str,
               keys: list[str] | None = None, epoch: int | None = None,
               prefer_latest: list[str] | None = None,
               source_seq: int | None = None) -> int:
        """Upsert ``source`` into a stored table on ``keys`` (default: the
        contract keys); returns the row delta and the partitions rewritten.

        prefer_latest: instead of the source row always winning, the row
            with the greatest ``prefer_latest`` tuple (NULLs last) wins
            between the stored and the source row of a key: "latest
            delivery wins" across runs, so deliveries loaded in any order
            give one result.

        Unpartitioned (or not yet written) tables get a new full version;
        those in buckets of their key are merged bucket by bucket, without an
        exchange of the stored rows.
        For a partitioned table only the touched partitions are read,
        merged and rewritten:

        1. touched partitions = those of the source rows, plus those where
           the source's keys live now (a semi-join over the target's key and
           partition columns only: a row whose time changed moves partition,
           and its old copy must go);
        2. merged = source rows combined with the touched target rows,
           written once to a staging table under the shared checkpoint
           folder (lineage cut: the job overwrites what it reads);
        3. the staging rows replace the touched partitions (dynamic
           partition overwrite); partitions left empty are removed;
           untouched partitions are neither read in full nor written.

        The list of touched partition values goes through the driver; it
        has at most one row per partition of the table.  The commit records
        the row delta and ``source_seq`` (the last source load merged, for
        incremental readers).
        """
        keys = keys or C.keys_of(layer, table)
        part_cols = C.TABLES[(layer, table)][2] if (layer, table) in C.TABLES else []
        schema = C.schema_of(layer, table)
        cur = self.current_version(layer, table)
        src = C.conform(source, schema)
        src_keys = checked_keys(src, keys)
        added, removed = Observation(), Observation()

        def combine(stored: DataFrame, columns: list[str]) -> DataFrame:
            new = src.select(*columns)
            if prefer_latest:
                ok = new.join(src_keys, keys, "left_semi")        # fails on bad keys
                out = latest_per_key(ok.unionByName(stored.select(*columns)), keys, prefer_latest,
                                     tie_columns=schema.fieldNames())
            else:
                out = checked_rows(new, keys).unionByName(
                    stored.join(src_keys, keys, "left_anti").select(*columns))
            return out.select(*columns).observe(added, F.count(F.lit(1)).alias("n"))

        if cur is None or not part_cols:
            before = 0 if cur is None else self._rows(layer, table)
            buckets = self._bucket_spec(layer, table)
            merged = None
            if buckets and keys == buckets[0] and not prefer_latest:
                merged = self.merged_buckets(src, layer, table)
            if merged is None:
                merged = combine(self.read(layer, table), schema.fieldNames())
                if buckets:
                    merged = merged.repartition(buckets[1], *buckets[0])
            df, parts, sort_by, rebalance = self._layout(merged, layer, table, None)
            version = (cur or 0) + 1
            rows = self._write(df, self._version_path(layer, table, version), "overwrite",
                               parts, sort_by, rebalance, buckets)
            self._commit(layer, table, version, rows, epoch, None, source_seq)
            return UpsertResult(rows - before, None)

        path = self._version_path(layer, table, cur)
        target = self._read_version(layer, table, cur)
        columns = target.columns
        src, _, _, _ = self._layout(src, layer, table, None)
        moved_from = target.select(*keys, *part_cols).join(src_keys, keys, "left_semi")
        touched = [r.asDict() for r in
                   moved_from.select(*part_cols).unionByName(src.select(*part_cols))
                   .distinct().collect()]
        if not touched:
            self._commit(layer, table, cur, 0, epoch, None, source_seq)
            return UpsertResult(0, [])
        old_rows = (target.where(self._any_match(touched, part_cols))
                    .observe(removed, F.count(F.lit(1)).alias("n")))
        merged = combine(old_rows, columns)
        self._rewrite_partitions(layer, table, path, target, merged, part_cols, touched)
        delta = observed(added) - observed(removed)
        self._commit(layer, table, cur, delta, epoch, None, source_seq)
        return UpsertResult(delta, touched)

    @staticmethod
    def _any_match(values: list[dict], part_cols: list[str]):
        """Rows of any of the partitions: one flat list, as there may be
        thousands.  Several columns are compared as one text, which prunes
        folders, too, as it is made of partition columns alone."""
        if len(part_cols) > 1:
            named = F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("?")) for p in part_cols])
            return named.isin(["/".join("?" if v[p] is None else str(v[p]) for p in part_cols) for v in values])
        (p,) = part_cols
        named = [v[p] for v in values if v[p] is not None]
        cond = F.col(p).isin(named) if named else F.lit(False)
        return F.coalesce(cond, F.lit(False)) | F.col(p).isNull() if len(named) < len(values) else cond

    def _rewrite_partitions(self, layer: str, table: str, path: str, target: DataFrame,
                            content: DataFrame, part_cols: list[str], touched: list[dict]) -> None:
        """Make ``content`` the complete content of the ``touched``
        partitions of the table at ``path`` (``target`` = its pre-write
        read).  ``content`` is written once to a staging folder under the
        shared checkpoint folder (cutting lineage, since ``content`` may read
        the partitions it replaces), then swapped in with a dynamic partition
        overwrite; touched partitions left without rows are removed.
        """
        columns = target.columns
        base = self.spark.conf.get("spark.checkpoint.dir", None) or self.root
        staging = f"{base}/tierflow-staging/{layer}-{table}-{uuid.uuid4().hex[:12]}"
        content = content.select(*columns)
        if (layer, table) in C.REBALANCE_ON_WRITE:
            content = content.hint("rebalance", *part_cols)     # files per value, not per task
        content.write.mode("overwrite").partitionBy(*part_cols).parquet(staging)
        staged = self.spark.read.schema(target.schema).parquet(staging).select(*columns)
        (staged.sortWithinPartitions(*part_cols, *C.SORT_WITHIN.get((layer, table), []))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*part_cols).parquet(path))
        # dynamic overwrite only replaces partitions that received rows: a
        # touched partition left empty (its rows all moved) is removed here
        # one row per partition value written (at most the touched ones)
        kept = {tuple(r) for r in staged.select(*part_cols).distinct().collect()}
        emptied = [v for v in touched if tuple(v[p] for p in part_cols) not in kept]
        if emptied:
            # folders of the old files in those partitions (pruned scan of
            # the pre-write listing; one row per folder comes back)
            folders = (target.where(self._any_match(emptied, part_cols))
                       .select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("d"))
                       .distinct().collect())
            for r in folders:
                self._delete_uri(r.d)
        self._delete(staging)                   # swapped in: the copy is no longer needed

    def vacuum(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Delete the folders of all but the newest ``keep`` committed
        versions of a table (readers still on a removed version fail, so
        keep at least the versions a running reader may use); returns the
        versions removed.  The commit log is kept."""
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = sorted({r["version"] for r in self._log_rows(layer, table)})
        drop = versions[:-keep]
        for v in drop:
            path = self._version_path(layer, table, v)
            if (layer, table) in C.BUCKETS:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucket_table(path)}")
            if self._exists(path):
                self._delete(path)
        if len(self._log_rows(layer, table)) - self._snapshot(layer, table) > 20:
            self.compact_log(layer, table)
        return drop

    def replace_partitions(self, content: DataFrame, layer: str, table: str,
                           touched: list[dict], source_seq: int | None = None) -> int:
        """Replace the ``touched`` partitions of a stored partitioned table
        with ``content`` (their complete new rows, contract columns); other
        partitions are not read or written.  Returns the row delta."""
        part_cols = C.TABLES[(layer, table)][2]
        cur = self.current_version(layer, table)
        if cur is None:
            raise FileNotFoundError(f"{layer}.{table} must exist before partial replacement")
        path = self._version_path(layer, table, cur)
        target = self._read_version(layer, table, cur)
        content, _, _, _ = self._layout(C.conform(content, C.schema_of(layer, table)),
                                        layer, table, None)
        before = target.where(self._any_match(touched, part_cols)).count()
        added = Observation()
        content = content.observe(added, F.count(F.lit(1)).alias("n"))
        self._rewrite_partitions(layer, table, path, target, content, part_cols, touched)
        delta = observed(added) - before
        self._commit(layer, table, cur, delta, source_seq=source_seq)
        return delta

    def _rows(self, layer: str, table: str) -> int:
        """Row count of the current version, from the commit log."""
        cur = self.current_version(layer, table)
        return int(sum(r["rows"] or 0 for r in self._log_rows(layer, table)
                       if r["version"] == cur))

    def register_views(self) -> list[str]:
        """Expose the current version of every stored contract table as a
        temporary view ``<layer>_<table>`` for ``spark.sql``; returns the
        view names."""
        names = []
        for (layer, table) in C.TABLES:
            if self.exists(layer, table):
                name = f"{layer}_{table}"
                self.read(layer, table).createOrReplaceTempView(name)
                names.append(name)
        return names

    def register_tables(self, prefix: str = "") -> list[str]:
        """Register every stored contract table in the session's catalog by its
        DDL: a database per layer (``<prefix><layer>``) and an external table on
        the files of the current version, with the partitions found there.
        Loads that were not committed are left out.  Registering again moves
        the tables to their newest versions.  Returns the table names."""
        names = []
        for (layer, table) in C.TABLES:
            if not self.exists(layer, table):
                continue
            database = f"{prefix}{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_catalog/{database}'")
            path = self._version_path(layer, table, self.current_version(layer, table))
            name = f"{database}.{table}"
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")          # external: the files stay
            self.spark.sql(C.ddl(layer, table, path, database))
            if C.TABLES[(layer, table)][2] or (layer, table) in C.LOAD_SEQUENCED:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            if (layer, table) in C.LOAD_SEQUENCED:
                self._forget_uncommitted(name, self.last_load_seq(layer, table))
            names.append(name)
        return names

    def _forget_uncommitted(self, name: str, last: int) -> None:
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {name}").where(
                F.regexp_extract("partition", "_load_seq=([0-9]+)", 1).cast("bigint") > last).collect():
            # a stopped load's folders only
            parts = [p.split("=", 1) for p in spec.split("/")]
            text = ", ".join(f"{k}=" + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for k, v in parts)
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({text})")

    def tables(self) -> DataFrame:
        """(layer, table, version, rows) of every committed table version
        (the row count of the last commit of that version)."""
        rows = []
        for (layer, table) in C.TABLES:
            log = self.log(layer, table)
            if log is None:
                continue
            rows.append(log.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"),
                                   "version", "rows", "committed_at"))
        if not rows:
            return self.spark.createDataFrame(
                [], "layer string, table string, version int, rows bigint, committed_at timestamp")
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out
