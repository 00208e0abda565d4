"""A local SparkSession for tests, benchmarks and examples.

On a cluster the caller supplies the session; nothing in the operators
depends on these settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_shared_dir(spark: SparkSession) -> SparkSession:
    """For programs on a local master: names a temporary folder as the shared
    one where the session names none. A cluster's setting is never replaced,
    and a cluster without one is left to fail."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return spark
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationflow-"))
    return spark


def local_session(cores: int | str = "*", *, shuffle_partitions: int = 8, app: str = "stationflow") -> SparkSession:
    return ensure_shared_dir(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
