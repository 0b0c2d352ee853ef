"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder.

On a cluster the checkpoint folder must be shared storage named by
``spark.checkpoint.dir``; it is read from the session.  Only a local-mode
session without that setting gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tessera") -> SparkSession:
    """Local session tuned for the small-SF tests and the bench."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores)))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture costs several JVM round trips per column
        # function; it only serves error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Rows handed to Python may be large (matrix blocks): bound batches by bytes too.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting it from ``spark.checkpoint.dir``.

    A private temporary folder is used only for local-mode sessions where the
    setting is absent (tests); a cluster without the setting is an error,
    because a machine-local folder does not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
