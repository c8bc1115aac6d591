"""Session construction and shared scratch locations.

Credentials never live here: JDBC helpers read them from the environment
(see ``tierflow.sources.jdbc``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tierflow job relies on.  The session zone is UTC so that
# ``*_utc`` columns and ``yyyyMMdd`` date keys mean what their names say.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of post-shuffle partitions, and so of the files written
    # after a REBALANCE: fewer, larger files for big tables
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # WindowGroupLimit turns "row_number() = 1" into a map-side top-1.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # remove reliable-checkpoint files once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tierflow",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with tierflow's settings.

    ``shuffle_partitions`` should be sized to the data: about one partition
    per 128-256 MB of shuffled data on a cluster, about the core count in
    local mode.  AQE coalesces small partitions at runtime either way.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder
    and is used as is.  Only where it is unset on a local master (tests) a
    private temporary folder is created and registered; on a cluster that
    folder would be out of the executors' reach, so ValueError is raised.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tierflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tierflow/{name}-{uuid.uuid4().hex[:12]}"


def env(name: str, default: str | None = None) -> str:
    """Read a setting from the environment; fail loudly if it is required."""
    val = os.environ.get(name, default)
    if val is None:
        raise KeyError(f"environment variable {name} is not set")
    return val
