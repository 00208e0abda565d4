"""Trips and rejected lines of trip files, from one scan.

``read_trip_files`` fails on a malformed line or leaves it out. Here every line is
judged once: a line with all trip fields in their types is a trip, any other one is
kept with its file and the reason. The result is stored in two halves, so that
neither reading the trips nor reading the rejected lines scans the files again."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.columns import file_key_sql, file_name_sql, month_label_sql
from stationflow.schema import FILE, FILE_NAME, MONTH, TRIP_SCHEMA
from stationflow.sources.files import new_shared_folder
from stationflow.sources.manifest import LISTED_THROUGH, belongs, input_roots
from stationflow.sources.trips import project_trips, trip_file_glob

LINE, REASON = "line", "reason"


class SplitTrips(NamedTuple):
    """``trips`` as :func:`read_trip_files` gives them, and ``rejected`` with
    ``file, file_name, month, line, reason``."""

    trips: DataFrame
    rejected: DataFrame


def reason_sql(line: str, record: str, schema: T.StructType) -> str:
    """Why a line is no trip (NULL: it is one): ``malformed``, else the first
    field of a ``wrong type``, else the first field that it ``lacks``."""
    fields = schema.fieldNames()
    text = {f: f"get_json_object({line}, '$.{f}')" for f in fields}
    wrong = [f"WHEN {record}.`{f}` IS NULL AND {text[f]} IS NOT NULL THEN 'wrong type: {f}'" for f in fields]
    lacks = [f"WHEN {record}.`{f}` IS NULL THEN 'lacks: {f}'" for f in fields]
    return f"CASE WHEN from_json({line}, 'map<string,string>') IS NULL THEN 'malformed' {' '.join(wrong + lacks)} END"


def judge_lines(lines: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """``file, file_name, month``, the record's fields, ``line`` and ``reason``
    (both NULL for a trip) of text rows ``file, value``; blank lines are left out."""
    judged = lines.where("value RLIKE '[^ \\t\\r\\n]'").select(FILE, F.col("value").alias(LINE), F.from_json("value", schema).alias("r"))
    judged = judged.selectExpr(FILE, LINE, "r", f"{reason_sql(LINE, 'r', schema)} AS {REASON}").selectExpr("*", f"{file_name_sql(FILE)} AS {FILE_NAME}")
    return judged.selectExpr(FILE, FILE_NAME, f"{month_label_sql(FILE_NAME)} AS {MONTH}", "r.*", f"IF({REASON} IS NULL, NULL, {LINE}) AS {LINE}", REASON)


def split_trip_files(
    spark: SparkSession, path: str | list[str], *, glob: str | None = trip_file_glob("json"), schema: T.StructType = TRIP_SCHEMA, options: dict[str, str] | None = None
) -> SplitTrips:
    """Trips and rejected lines of the JSON Lines files in ``path``, judged in one
    scan and stored in the shared folder. An empty folder gives two empty tables."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.options(**LISTED_THROUGH, **(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths).where(belongs(input_roots(spark, paths))).selectExpr("value", f"{file_key_sql()} AS {FILE}")
    judged = judge_lines(lines, schema).withColumn("rejected", F.col(REASON).isNotNull())
    folder = new_shared_folder(spark, "split-trips")
    judged.write.partitionBy("rejected").parquet(folder)
    stored = spark.read.schema(judged.schema).parquet(folder)
    return SplitTrips(
        project_trips(stored.where("NOT rejected").drop("rejected", LINE, REASON)),
        stored.where("rejected").select(FILE, FILE_NAME, MONTH, LINE, REASON),
    )


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """``file, file_name, month, reason, lines``: rejected lines per file."""
    return rejected.groupBy(FILE, FILE_NAME, MONTH, REASON).agg(F.count(F.lit(1)).alias("lines"))
