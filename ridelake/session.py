"""Session building for local use, and the shared folder every job may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# State store required by the stateful operator; handed to each streaming query.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: str = "*", memory: str = "8g", app_name: str = "ridelake") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset, as in a
    local test, a fresh folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        current = spark.sparkContext.getCheckpointDir()
        if current is not None:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="ridelake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/ridelake/{label}-{uuid.uuid4().hex}"
