"""Session helpers: one place for the configuration the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Limits the library checks before anything is broadcast to executors.
# Overridable per session with `quarry.broadcast.maxBytes`.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    On a cluster, pass no master and let spark-submit decide; the checkpoint
    directory must then come from the cluster (``spark.checkpoint.dir``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    parts = shuffle_partitions or os.environ.get("QUARRY_SHUFFLE_PARTITIONS")
    if not parts and master and master.startswith("local"):
        parts = 8
    if parts:  # else the cluster's own value holds
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    b = (b.config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    Reads ``spark.checkpoint.dir``. Only a local-mode session (tests, the
    bench) gets a fresh temporary directory of its own; a cluster session
    without the setting is an error, since a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative operators")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def broadcast_limit(spark: SparkSession) -> int:
    v = spark.conf.get("quarry.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES
