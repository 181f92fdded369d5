"""SparkSession factory for tests, benchmarks and local runs.

On a cluster the session comes from the platform; every setting here is applied only
when it is not set already, so cluster-wide choices (checkpoint dir, partitions) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tally-wh-"))
    )
    for k, v in REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    On a cluster it is the shared folder that ``spark.checkpoint.dir`` names; without one a
    cluster session raises, since a machine-local folder would be invisible to the other
    machines. Only a local session (tests) gets a scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's setting applies
        sc = None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tally-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
