"""Session helpers: local sessions for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Broadcast guard defaults (rows). A lookup side is broadcast only when a bounded
# count proves it holds at most this many rows; otherwise a shuffle join is used.
BROADCAST_MAX_ROWS_KEY = "formlake.broadcast.maxRows"
BROADCAST_MAX_ROWS_DEFAULT = 1_000_000
BROADCAST_MAX_BYTES_KEY = "formlake.broadcast.maxBytes"
BROADCAST_MAX_BYTES_DEFAULT = 64 << 20
# Rows one task should handle for a single hot key before the key is salted.
ROWS_PER_TASK_KEY = "formlake.skew.rowsPerTask"
ROWS_PER_TASK_DEFAULT = 2_000_000


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value not in (None, "") else default


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "formlake") -> SparkSession:
    """A local session tuned like the tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # many small filing texts: pack them into fewer, larger read tasks
        .config("spark.sql.files.openCostInBytes", str(64 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (a core setting, fixed at start-up) names a shared folder on a
    cluster and is used as is. Only when it is unset (local tests) does this point the
    SparkContext at a fresh local folder; the core setting itself cannot be changed at
    run time.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.removeprefix("file:")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        current = tempfile.mkdtemp(prefix="formlake-ckpt-")
        spark.sparkContext.setCheckpointDir(current)
    return current.removeprefix("file:")


def staged(df, label: str):
    """``df`` written once to a fresh table in the shared folder and read back: computed once,
    lineage cut, every executor reaches the files."""
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession):
    """A staging folder in the shared folder for one run: yields ``stage(df, label)`` (see ``staged``),
    and the folder is deleted at the end."""
    path = scratch_path(spark, f"run-{uuid.uuid4().hex[:12]}")

    def stage(df, label: str):
        df.write.parquet(f"{path}/{label}")
        return spark.read.schema(df.schema).parquet(f"{path}/{label}")

    try:
        yield stage
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the checkpoint folder (shared on a cluster)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
