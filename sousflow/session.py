"""Session helpers for tests, the bench and local runs.

Library code never builds its own session; it takes the caller's. These helpers
only fill settings that are unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution re-plans joins from runtime
# sizes (the size check behind broadcast) and splits skewed shuffle partitions.
ADAPTIVE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sousflow") -> SparkSession:
    """A local session for tests, the bench and the oracle check."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in ADAPTIVE_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint directory, taken from ``spark.checkpoint.dir`` if needed; None when nothing is configured.

    On a cluster that setting names a shared folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def materialised(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` in the session's checkpoint directory, whatever the size of the data.

    A session that runs on one machine and has no directory gets a scratch one; on a
    cluster the folder must be shared, so there a missing setting is an error.
    """
    sc = df.sparkSession.sparkContext
    if ensure_checkpoint_dir(df.sparkSession) is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sousflow-ckpt-"))
    return df.checkpoint()
