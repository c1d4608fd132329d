"""Session construction and cluster-shared locations."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC windows, AQE for runtime coalescing and
# skew splitting, and Arrow for the few Python folds.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline") -> SparkSession:
    """Local/test session. On a cluster the submitter's session is used as is."""
    master = master or os.environ.get("LEDGERLINE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.bindAddress", "127.0.0.1")
    builder = builder.config("spark.driver.host", "127.0.0.1")
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the runtime settings the operators assume (UTC windows, AQE)."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.execution.arrow.pyspark.enabled"):
        if spark.conf.get(key, None) != SESSION_DEFAULTS[key]:
            spark.conf.set(key, SESSION_DEFAULTS[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's value is always used; a folder of our own is set only when
    the session has none (local tests).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() or None
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished stages (it acts when the driver's JVM collects)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
