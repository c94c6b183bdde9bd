"""Session helpers: a local session for tests and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names
(a shared file system such as HDFS or an object store).  Only a local-mode
session without that setting gets a fresh folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "spendstar",
                  driver_memory: str = "8g", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Read from the session (``spark.checkpoint.dir`` or an already set
    checkpoint directory).  Only when it is unset on a local master do we
    create one, as the tests do; on a cluster an unset value is an error,
    because a machine-local folder would not survive executor loss.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client (e.g. Spark Connect)
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, object store) so materialised tables survive executor loss")
    local = tempfile.mkdtemp(prefix="spendstar-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder for one materialised table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
