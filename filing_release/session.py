"""Spark session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are still unset, so cluster-wide values (shuffle partitions,
checkpoint folder, AQE) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the release jobs rely on.  Applied only when the session has no
# value of its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even when a later aggregate needs the
    # key partitioning: AQE then adds a shuffle whose map-side partial
    # aggregation collapses the hot key (otherwise one task gets it all)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "filing_release") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    ckpt = os.environ.get("SPARK_CHECKPOINT_DIR") or tempfile.mkdtemp(
        prefix="filing-release-ckpt-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.checkpoint.dir", ckpt)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in release-job defaults without overriding cluster settings."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets this to a shared file system; it is read
    from the session and used as is.  Sessions without one (ad-hoc local
    runs) get a private folder, which is only acceptable off-cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="filing-release-ckpt-")
    sc.setCheckpointDir(local)
    return local
