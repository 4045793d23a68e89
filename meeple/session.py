"""Session helpers: one place for the settings every job relies on.

Production sessions come from ``spark-submit`` with cluster settings; these
helpers only add what the library needs (UTC session time zone, AQE) and
read the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (UTC day buckets) and for
# runtime re-planning at scale (AQE: partition coalescing, skew-join splitting,
# broadcast conversion from measured shuffle sizes).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "meeple") -> SparkSession:
    """A local session for tests and the bench (no UI, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MEEPLE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on a remote session
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir). Only when neither is set on a local master (tests, a
    laptop) a private folder is created; on a cluster that is an error, as a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the server owns the setting
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                           "for checkpoints and scratch tables")
    own = tempfile.mkdtemp(prefix="meeple-ckpt-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir() or own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/meeple/{name}-{uuid.uuid4().hex}"
