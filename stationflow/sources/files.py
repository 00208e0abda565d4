"""Writing trip files, and the shared folder they are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stationflow.functions.columns import FILE_DIR
from stationflow.schema import FILE_NAME
from stationflow.sources.trips import trip_records


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate data, as the session names
    it in ``spark.checkpoint.dir`` (or as its checkpoint directory was set).
    The caller gives the folder; there is no fallback, because a folder of one
    machine is not visible to the other executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the folder
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not (current or configured):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if current:
        return current
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def new_shared_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh, unused folder under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data that the caller owns."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The integer values of a table's ``column=<value>`` folders, in order."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = [s.getPath().getName().partition("=") for s in found]
    return sorted(int(value) for name, _, value in names if name == column and value.isdigit())


def write_trip_files(trips: DataFrame, folder: str, *, fmt: str = "json") -> str:
    """Write trips as trip files into ``folder`` and return it.

    A file is a directory ``file=<file_name>`` of parts, which the readers take
    as one observation however many parts it has. Rows are rebalanced on the
    file first: with adaptive execution on (the default), Spark splits a file
    larger than the advisory partition size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) over several tasks and
    packs small ones into one, so part sizes stay near that size. Each task
    writes its parts in place; nothing is renamed or moved by the driver."""
    name = FILE_DIR.rstrip("=")
    records = trip_records(trips).withColumnRenamed(FILE_NAME, name)
    records.hint("rebalance", name).write.mode("errorifexists").partitionBy(name).format(fmt).save(folder)
    return folder
