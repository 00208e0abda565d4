"""Incremental analysis of trip files as they land in a folder.

Monthly trip files arrive one after another. A Structured Streaming file
source picks up new files; every file is read whole within one micro-batch,
so the per-file station table a batch produces is already final and needs
no streaming state. Each batch appends its table, keyed by batch id, to a
per-file table in the shared folder (a replayed batch rewrites the same
key, so the sink is idempotent), and the reports run on that table. A table
belongs to one stream checkpoint: starting a new checkpoint on a filled table,
which would store its files twice, is refused.

A file stored in parts (``file=<name>``) may reach the stream in several
batches; its measures are stored as sums and counts, which add up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.ends import filter_user_type, trip_ends
from stationflow.operators.stations import merge_station_sums, station_stats_of_sums, station_sums
from stationflow.plans.reports import VARIANTS, ordered, original_layout, variant_reports
from stationflow.schema import TOP_PER_FILE, TOP_TOTAL, TRIP_SCHEMA
from stationflow.sources.manifest import LISTED_THROUGH, belongs, input_roots
from stationflow.sources.trips import _BY_FORMAT, label_trip_records, trip_file_glob
from stationflow.streaming.snapshots import publish_reports

BATCH = "batch"
# Files are read however old they are: monthly archives copied with their
# times are the normal case. (The file source forgets files older than this.)
_MAX_FILE_AGE = "36500d"


def read_trip_stream(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "json",
    glob: str | None = _BY_FORMAT,
    schema: T.StructType = TRIP_SCHEMA,
    mode: str = "FAILFAST",
    max_files_per_trigger: int | None = None,
    with_user: bool = True,
    strict: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming trips from the trip files that appear in ``path``, with the
    same labelling, projection and strictness as the batch scan. No file is
    left out for its age."""
    glob = trip_file_glob(fmt, glob)
    reader = spark.readStream.schema(schema).option("maxFileAge", _MAX_FILE_AGE)
    reader = reader.options(**LISTED_THROUGH, **(options or {})).option("mode", mode)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "json":
        raw = reader.json(path)
    else:
        raw = reader.parquet(path)
    raw = raw.where(belongs(input_roots(spark, [path])))
    return label_trip_records(raw, schema=schema, with_user=with_user, strict=strict)


def per_file_stats_writer(table_path: str, *, user_type: int | None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: per-file station table of one batch,
    written under ``batch=<id>`` (overwritten if the batch is replayed)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = station_sums(trip_ends(filter_user_type(batch, user_type)))
        sums.write.mode("overwrite").parquet(f"{table_path}/{BATCH}={batch_id}")

    return write


def _holds(spark: SparkSession, path: str, fmt: str) -> bool:
    try:
        return bool(spark.read.format(fmt).load(path).take(1))
    except AnalysisException:  # the path does not exist yet, or holds no file
        return False


def _start(trips, write, table_path, checkpoint_path: str, available_now: bool, processing_time: str | None):
    spark = trips.sparkSession
    if not _holds(spark, f"{checkpoint_path}/metadata", "text") and _holds(spark, table_path, "parquet"):
        raise ValueError(f"{table_path} was filled by another stream; use its checkpoint or an empty table")
    writer = trips.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_incremental_stats(
    trips: DataFrame,
    table_path: str,
    checkpoint_path: str,
    *,
    user_type: int | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream from ``trips`` (see :func:`read_trip_stream`) into
    the per-file table at ``table_path``. ``checkpoint_path`` must be in a
    folder every executor and the driver share (for example under
    ``spark.checkpoint.dir``). ``available_now`` processes what is there and
    stops; otherwise the query runs on ``processing_time`` triggers."""
    write = per_file_stats_writer(table_path, user_type=user_type)
    return _start(trips, write, table_path, checkpoint_path, available_now, processing_time)


def start_incremental_reports(
    trips: DataFrame,
    table_path: str,
    reports_path: str,
    checkpoint_path: str,
    *,
    variant: str = "v3",
    k_file: int = TOP_PER_FILE,
    k_total: int = TOP_TOTAL,
    original_headers: bool = False,
    snapshots: bool = False,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """As :func:`start_incremental_stats` with the variant's user filter,
    and after every batch the variant's reports are recomputed from the
    stored per-file table (files x stations rows, never the trips) and
    written to ``reports_path/<report>``, replacing the previous version
    (in the original table layout with ``original_headers``). With ``snapshots``
    they are published as a version instead, which readers see whole or not at
    all (:func:`published_reports`)."""
    spark = trips.sparkSession
    append = per_file_stats_writer(table_path, user_type=VARIANTS[variant]["user_type"])

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        write_reports(
            spark, table_path, reports_path, variant=variant, k_file=k_file, k_total=k_total, original_headers=original_headers, snapshots=snapshots
        )

    return _start(trips, write, table_path, checkpoint_path, available_now, processing_time)


def write_reports(
    spark: SparkSession,
    table_path: str,
    reports_path: str,
    *,
    variant: str = "v3",
    k_file: int = TOP_PER_FILE,
    k_total: int = TOP_TOTAL,
    original_headers: bool = False,
    snapshots: bool = False,
) -> None:
    """The variant's reports from the stored table, replacing earlier ones, or
    published as a new version. Nothing is written while the table is empty."""
    if not _holds(spark, table_path, "parquet"):
        return
    stats = stored_station_stats(spark, table_path)
    reports = variant_reports(stats, variant, k_file=k_file, k_total=k_total)
    if original_headers:
        reports = {name: original_layout(ordered(report)) for name, report in reports.items()}
    if snapshots:
        publish_reports(spark, reports_path, reports)
        return
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{reports_path.rstrip('/')}/{name}")


def stored_station_stats(spark: SparkSession, table_path: str) -> DataFrame:
    """The accumulated per-file station table written by the stream, the sums
    of files that came in several batches added up."""
    return station_stats_of_sums(merge_station_sums(spark.read.parquet(table_path).drop(BATCH)))
