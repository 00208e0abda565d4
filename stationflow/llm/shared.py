"""Tables written to the shared folder between steps.

A stored table cuts lineage: losing an executor afterwards re-reads files, it
does not repeat earlier steps."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import stationflow
from stationflow.sources import new_shared_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet under the folder that the session names in
    ``spark.checkpoint.dir``, read again."""
    spark = df.sparkSession
    path = new_shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application: worker
    functions refer to it by import. Harmless where it is installed."""
    context = spark.sparkContext
    if getattr(context, "_stationflow_shipped", None):
        return
    root = Path(stationflow.__file__).parent
    archive = Path(context._temp_dir) / "stationflow-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._stationflow_shipped = True
