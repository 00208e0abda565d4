"""A per-file station table that follows its folder.

Files come, come again and go. A ledger holds, for each logical file, the print of
its stored parts (paths, lengths, times) and the run that read it. A refresh lists
the folder, compares prints, reads only new and changed files and replaces their
sums; a file that is gone loses its sums. So the table equals one that was made
afresh from the folder as it is, and a refresh reads what has changed.

The totals over all files run along: for each station, the number and the sum of its
per-file values, which are rounded before they are added, so that sums are exact. A
file's values as they were are taken out when it has changed or gone, its new ones
added. A refresh reads the totals before it and the stored sums of changed files,
however many files there are.

A run writes its sums under ``sums/run=<n>`` and totals under ``totals/run=<n>``,
then its ledger rows under ``ledger/run=<n>``, which is what completes it: a run that was killed before is
unknown to readers, and the next one overwrites its slice. Runs of one table must
not overlap.

``compact_station_table`` merges slices by levels: as many slices of one order of
magnitude (counted in files that they still hold) as the fan-in become one, so after
any number of refreshes each order has fewer slices than that. A compaction is a run
like any other: merged sums, totals, then a ledger of all files that says which slice
holds each. Killed before its ledger, it leaves the table as it was. What it replaces
stays until the next one, for readers that planned before it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.columns import half_even_sql
from stationflow.operators.ends import filter_user_type, trip_ends
from stationflow.operators.stations import connections_with_time_of, station_stats_of_sums, station_sums, station_times_of
from stationflow.schema import CONNECTIONS, FILE, MEAN_TIME, STATION, TIME_FROM, TIME_TO, TRIP_SCHEMA
from stationflow.sources.files import delete_folder, new_shared_folder, partition_values
from stationflow.sources.manifest import LISTED_THROUGH, literal_path, trip_file_manifest
from stationflow.sources.trips import _BY_FORMAT, label_trip_records, trip_file_glob

RUN = "run"
SLICE = "slice"
_LEDGER = f"{FILE} string, print string, gone boolean, {SLICE} long, {RUN} long"
#: Slices of one order of magnitude that are merged into one.
FAN_IN = 8


def _ledger(spark: SparkSession, table_path: str) -> DataFrame:
    """The last complete run's entry of each file, with the slice that holds the
    file's sums: the run's own, unless a compaction names another. Entries from
    before the last compaction, which lists all files, are not read."""
    try:
        rows = spark.read.schema(_LEDGER).parquet(f"{table_path}/ledger")
    except AnalysisException:  # no run yet
        rows = spark.createDataFrame([], _LEDGER)
    last = rows.where(F.col(RUN) >= _compacted(rows)).groupBy(FILE).agg(F.max(F.struct(RUN, "print", "gone", SLICE)).alias("last"))
    return last.select(FILE, "last.*").withColumn(SLICE, F.coalesce(SLICE, RUN))


def _compacted(rows: DataFrame) -> int:
    """The run of the last compaction (0: none)."""
    return rows.where(F.col(SLICE).isNotNull()).agg(F.max(RUN)).first()[0] or 0


def folder_changes(spark: SparkSession, folder: str | list[str], table_path: str, *, glob: str | None = None) -> DataFrame:
    """``file, print, gone`` of the files that are new, changed or gone since the
    table's last run."""
    parts = trip_file_manifest(spark, folder, glob=glob)
    one = F.xxhash64("path", "length", "modified").cast("decimal(38,0)")
    now = parts.groupBy(FILE).agg(F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.sum(one)).alias("print"))
    known = _ledger(spark, table_path).where("NOT gone").select(F.col(FILE).alias("_file"), F.col("print").alias("_print"))
    both = now.join(known, F.col(FILE) == F.col("_file"), "full_outer")
    return both.where("NOT (print <=> _print)").selectExpr(f"coalesce({FILE}, _file) AS {FILE}", "print", "print IS NULL AS gone")


def refresh_station_table(
    spark: SparkSession,
    folder: str | list[str],
    table_path: str,
    *,
    fmt: str = "json",
    glob: str | None = _BY_FORMAT,
    mode: str = "FAILFAST",
    user_type: int | None = None,
) -> dict[str, int]:
    """Bring the table up to the folder's state; gives the numbers of files
    ``read`` and ``gone``. One table holds one user filter."""
    glob = trip_file_glob(fmt, glob)
    noted = new_shared_folder(spark, "folder-changes")
    folder_changes(spark, folder, table_path, glob=glob).write.parquet(noted)
    changes = spark.read.parquet(noted)
    counts = {bool(r["gone"]): r["n"] for r in changes.groupBy("gone").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {"read": 0, "gone": 0}
    run = (_ledger(spark, table_path).agg(F.max(RUN)).first()[0] or 0) + 1
    if counts.get(False):
        # The files to open, as Spark lists the files of any scan on the driver.
        parts = trip_file_manifest(spark, folder, glob=glob).join(changes.where("NOT gone").select(FILE), FILE, "left_semi")
        paths = [literal_path(r["path"]) for r in parts.select("path").collect()]
        reader = spark.read.schema(TRIP_SCHEMA).options(**LISTED_THROUGH)
        raw = reader.option("mode", mode).json(paths) if fmt == "json" else reader.parquet(*paths)
        sums = station_sums(trip_ends(filter_user_type(label_trip_records(raw), user_type)))
        sums.write.mode("overwrite").parquet(f"{table_path}/sums/{RUN}={run}")
    _totals(spark, table_path, changes, run, new=bool(counts.get(False))).write.mode("overwrite").parquet(f"{table_path}/totals/{RUN}={run}")
    changes.write.mode("overwrite").parquet(f"{table_path}/ledger/{RUN}={run}")
    return {"read": counts.get(False, 0), "gone": counts.get(True, 0)}


# --- running totals -------------------------------------------------------------

#: Measures with a total: rounded per-file values (halves at most).
_MEASURES = (CONNECTIONS, MEAN_TIME, TIME_FROM, TIME_TO)
_STATE = f"{STATION} long, " + ", ".join(f"n_{m} long, sum_{m} double" for m in _MEASURES)


def _values(stats: DataFrame) -> DataFrame:
    """The per-file values that totals are made of."""
    counted = connections_with_time_of(stats, rounded=True).select(STATION, CONNECTIONS, MEAN_TIME)
    timed = station_times_of(stats, rounded=True).select(STATION, TIME_FROM, TIME_TO)
    return counted.unionByName(timed, allowMissingColumns=True)


def _state(values: DataFrame, sign: int) -> DataFrame:
    sums = [F.expr(f"{sign} * {how} AS {name}_{m}") for m in _MEASURES for name, how in (("n", f"count({m})"), ("sum", f"coalesce(sum(CAST({m} AS DOUBLE)), 0D)"))]
    return values.groupBy(STATION).agg(*sums)


def _totals(spark: SparkSession, table_path: str, changes: DataFrame, run: int, *, new: bool) -> DataFrame:
    """The totals after a run: those before, less what changed and gone files
    gave, plus what the run's files give."""
    parts = []
    known = _ledger(spark, table_path)
    last = known.agg(F.max(RUN)).first()[0]
    if last:
        parts.append(spark.read.schema(_STATE).parquet(f"{table_path}/totals/{RUN}={last}"))
        before = known.where("NOT gone").join(changes.select(FILE), FILE, "left_semi").select(F.col(FILE).alias("_file"), F.col(SLICE).alias("_run"))
        runs = [r["_run"] for r in before.select("_run").distinct().collect()]
        if runs:
            sums = spark.read.parquet(f"{table_path}/sums").where(F.col(RUN).isin(runs))
            old = sums.join(before, (F.col(FILE) == F.col("_file")) & (F.col(RUN) == F.col("_run")), "left_semi")
            parts.append(_state(_values(station_stats_of_sums(old.drop(RUN))), -1))
    if new:
        parts.append(_state(_values(station_stats_of_sums(spark.read.parquet(f"{table_path}/sums/{RUN}={run}"))), 1))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    summed = merged.groupBy(STATION).agg(*[F.sum(c).alias(c) for m in _MEASURES for c in (f"n_{m}", f"sum_{m}")])
    return summed.where(f"n_{CONNECTIONS} > 0")


def running_totals(spark: SparkSession, table_path: str) -> DataFrame:
    """``station, connections, mean_time, time_from, time_to``: the totals over all
    files that the last complete run saw (the last two NULL for a station that no
    file has both times of)."""
    last = _ledger(spark, table_path).agg(F.max(RUN)).first()[0]
    state = spark.read.schema(_STATE).parquet(f"{table_path}/totals/{RUN}={last}") if last else spark.createDataFrame([], _STATE)
    means = [f"{half_even_sql(f'try_divide(sum_{m}, n_{m})')} AS {m}" for m in _MEASURES]
    return state.selectExpr(STATION, *means)


def refreshed_station_stats(spark: SparkSession, table_path: str) -> DataFrame:
    """The per-file station table (as ``station_stats`` gives it) of the files
    that the last complete run saw."""
    return station_stats_of_sums(_live_sums(spark, table_path, _ledger(spark, table_path).where("NOT gone")))


def _live_sums(spark: SparkSession, table_path: str, files: DataFrame) -> DataFrame:
    """Stored sums of those entries of the ledger."""
    live = files.select(F.col(FILE).alias("_file"), F.col(SLICE).alias("_run"))
    slices = [r["_run"] for r in live.select("_run").distinct().collect()]  # few, other slices are not opened
    if not slices:
        return spark.read.parquet(f"{table_path}/sums").where("false").drop(RUN)
    sums = spark.read.option("mergeSchema", "false").parquet(f"{table_path}/sums").where(F.col(RUN).isin(slices))
    return sums.join(live, (F.col(FILE) == F.col("_file")) & (F.col(RUN) == F.col("_run")), "left_semi").drop(RUN)


# --- compaction -------------------------------------------------------------------


def slices_to_merge(files: dict[int, int], fan_in: int = FAN_IN) -> list[int]:
    """Slices to merge, given the files that each still holds: those of the lowest
    order of magnitude (to the base of the fan-in) that has ``fan_in`` of them, and
    of higher ones that the merged slice would fill up in turn."""
    def order(n: int) -> int:
        return next(i for i in range(n.bit_length() + 1) if n < fan_in ** (i + 1))

    chosen: list[int] = []
    for level in sorted({order(n) for n in files.values()}):
        own = [s for s in sorted(files) if order(files[s]) == level]
        merged = order(sum(files[s] for s in chosen)) if chosen else -1
        if len(own) + (merged == level) >= fan_in:
            chosen += own
        elif chosen and merged <= level:
            break
    return chosen


def compact_station_table(spark: SparkSession, table_path: str, *, fan_in: int = FAN_IN) -> int:
    """Merge small slices of the table; gives the number of slices merged (0:
    there was nothing to do). Results don't change."""
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    live = _ledger(spark, table_path).where("NOT gone")
    # One row per slice: fewer than fan_in of each order, and those since the last compaction.
    files = {r[SLICE]: r["n"] for r in live.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = slices_to_merge(files, fan_in)
    if not chosen:
        return 0
    last = _ledger(spark, table_path).agg(F.max(RUN)).first()[0]
    run = last + 1
    moved = F.col(SLICE).isin(chosen)
    merged = _live_sums(spark, table_path, live.where(moved)).hint("rebalance")
    merged.write.mode("overwrite").parquet(f"{table_path}/sums/{RUN}={run}")
    totals = spark.read.schema(_STATE).parquet(f"{table_path}/totals/{RUN}={last}")
    totals.write.mode("overwrite").parquet(f"{table_path}/totals/{RUN}={run}")
    noted = live.select(FILE, "print", "gone", F.when(moved, F.lit(run)).otherwise(F.col(SLICE)).alias(SLICE))
    noted.write.mode("overwrite").parquet(f"{table_path}/ledger/{RUN}={run}")
    _drop_replaced(spark, table_path, set(files), run)
    return len(chosen)


def _drop_replaced(spark: SparkSession, table_path: str, live: set[int], run: int) -> None:
    """Remove what no reader needs since the compaction before this one: slices
    that held no file any more when this one began, ledgers and totals before that
    one. Ledgers go oldest first, so a removal that breaks off revives no file."""
    for old in partition_values(spark, f"{table_path}/sums", RUN):
        if old < run and old not in live:
            delete_folder(spark, f"{table_path}/sums/{RUN}={old}")
    before = _compacted(spark.read.schema(_LEDGER).parquet(f"{table_path}/ledger").where(F.col(RUN) < run))
    for part in ("ledger", "totals"):
        for old in partition_values(spark, f"{table_path}/{part}", RUN):
            if old < before:
                delete_folder(spark, f"{table_path}/{part}/{RUN}={old}")
