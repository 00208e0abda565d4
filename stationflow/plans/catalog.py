"""Registered queries over the test tables, and their SQL oracles.

Every query derives trips from the whole ``lineitem`` table and runs one
operator or report on them. Each oracle is an independent SQL statement over
the same table, with the same column names and types, written for DuckDB
(``round_even`` is its half-even rounding)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import operators as op
from stationflow.functions.columns import month_label
from stationflow.plans import reports
from stationflow.schema import CONNECTIONS, FILE, FILE_NAME, MONTH, STATION
from stationflow.sources.files import delete_folder, new_shared_folder, write_trip_files
from stationflow.sources.rejected import LINE, REASON, split_trip_files
from stationflow.sources.trips import (
    parse_trip_json,
    project_trips,
    read_trip_files,
    trip_records,
    trip_records_from_lineitem,
    trip_records_json,
    trips_from_lineitem,
)
from stationflow.streaming import (
    compact_station_table,
    read_trip_stream,
    refresh_station_table,
    refreshed_station_stats,
    running_totals,
    start_incremental_stats,
    stored_station_stats,
)

Query = Callable[[SparkSession, str], DataFrame]

# Most elements of a chunk in ``connection_list_chunks``.
_CHUNK_SIZE = 25

# Months of the first of two separately processed batches in ``union_months``.
_FIRST_BATCH_BEFORE = "199807"
# Files per micro-batch read by the stream query.
_FILES_PER_TRIGGER = 16


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(spark, sf_dir)


def _annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.filter_user_type(_trips(spark, sf_dir), 1)


def _ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trip_ends(_trips(spark, sf_dir))


def _annual_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trip_ends(_annual(spark, sf_dir))


def _scan_trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the trips as JSON Lines files into the shared folder, then read
    the folder back with the trip file scan."""
    folder = new_shared_folder(spark, "trip-files")
    write_trip_files(_trips(spark, sf_dir), folder)
    return read_trip_files(spark, folder)


def _union_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time tables of two batches of files, computed apart and stacked."""
    trips = _annual(spark, sf_dir)
    early = F.coalesce(F.col(MONTH) < F.lit(_FIRST_BATCH_BEFORE), F.lit(False))
    first, second = trips.where(early), trips.where(~early)  # trips without a month are in the second
    return op.union_months(
        op.station_times(op.trip_ends(first), rounded=True),
        op.station_times(op.trip_ends(second), rounded=True),
    )


def _stream_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental path end to end: trips written as monthly files, a
    file stream (several files per micro-batch) appending per-file station
    tables, and the accumulated table read back, per month label and
    station."""
    base = new_shared_folder(spark, "trip-stream")
    write_trip_files(_trips(spark, sf_dir), f"{base}/files")
    stream = read_trip_stream(spark, f"{base}/files", max_files_per_trigger=_FILES_PER_TRIGGER)
    query = start_incremental_stats(
        stream, f"{base}/stats", f"{base}/checkpoint", user_type=None, available_now=True
    )
    query.awaitTermination()
    stats = stored_station_stats(spark, f"{base}/stats")
    return stats.groupBy(MONTH, STATION).agg(F.expr(f"sum({CONNECTIONS}) AS {CONNECTIONS}"))


def _mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one folder that holds every second month plainly and the others
    in parts, read by one scan."""
    folder = new_shared_folder(spark, "mixed-layout")
    trips = _trips(spark, sf_dir)
    plain = f"coalesce(CAST({MONTH} AS INT), 0) % 2 = 1"
    write_trip_files(trips.where(f"NOT ({plain})"), folder)
    _write_plain_files(trips.where(plain), folder)
    return read_trip_files(spark, folder).drop(FILE_NAME)


def _write_plain_files(trips: DataFrame, folder: str) -> None:
    """One plain file ``<name>.json`` for each file name: written as a part each,
    then renamed (the input's months are few)."""
    spark = trips.sparkSession
    staging = new_shared_folder(spark, "plain-files")
    trip_records(trips).withColumnRenamed(FILE_NAME, "name").repartition("name").write.partitionBy("name").json(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in system.globStatus(path(f"{staging}/name=*/*.json")):
        name = part.getPath().getParent().getName().removeprefix("name=")
        if not system.rename(part.getPath(), path(f"{folder}/{name}.json")):
            raise OSError(f"{folder}/{name}.json could not be written")


def _rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of trip files in which some lines are cut short, lack a
    field or hold text for a number."""
    records = trip_records_from_lineitem(spark, sf_dir)
    read = trip_records_json(project_trips(records)).withColumn("r", F.expr("from_json(value, 'travel_time long, idunplug_station long, idplug_station long')"))
    lines = read.withColumn("k", F.expr("(7 * r.travel_time + 13 * r.idunplug_station + r.idplug_station) % 97"))
    damaged = lines.selectExpr(
        FILE_NAME,
        "CASE k WHEN 0 THEN left(value, length(value) - 1) WHEN 1 THEN replace(value, '\"travel_time\":', '\"travel_time\":\"x\",\"t\":')"
        " WHEN 2 THEN replace(value, 'idplug_station', 'station') ELSE value END AS value",
    )
    folder = new_shared_folder(spark, "damaged-lines")
    damaged.withColumnRenamed(FILE_NAME, "file").write.partitionBy("file").text(folder)
    return split_trip_files(spark, folder, glob="*.txt").rejected.select(MONTH, LINE, REASON)


# Months that come shortened first and whole later, and one that goes.
_REDELIVERED_FROM, _REMOVED = "199601", "199808"


def _refreshed_folder(spark: SparkSession, sf_dir: str) -> str:
    """A station table refreshed twice: from a first delivery, in which later
    months hold few trips, then after these came again and one month went."""
    base = new_shared_folder(spark, "refreshed")
    trips = _trips(spark, sf_dir)
    later = F.coalesce(F.col(MONTH) >= F.lit(_REDELIVERED_FROM), F.lit(False))
    write_trip_files(trips.where(~later | (F.col("user_type") <= 2)), f"{base}/files")
    refresh_station_table(spark, f"{base}/files", f"{base}/table")
    whole = trip_records(trips.where(later)).withColumnRenamed(FILE_NAME, "file")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").json(f"{base}/files")
    delete_folder(spark, f"{base}/files/file={_REMOVED}")
    refresh_station_table(spark, f"{base}/files", f"{base}/table")
    return f"{base}/table"


def _refreshed_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections per file of the refreshed station table."""
    return op.connections_of(refreshed_station_stats(spark, _refreshed_folder(spark, sf_dir)))


def _running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all files that ran along with the refreshes."""
    return running_totals(spark, _refreshed_folder(spark, sf_dir))


def _compacted_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections per file after the slices of two refreshes became one."""
    table = _refreshed_folder(spark, sf_dir)
    compact_station_table(spark, table, fan_in=2)
    return op.connections_of(refreshed_station_stats(spark, table))


def _list_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection lists in chunks, each shown as ``other:time`` in order."""
    chunks = op.connection_list_chunks(op.connection_lists(_ends(spark, sf_dir)), size=_CHUNK_SIZE)
    shown = "concat_ws(',', transform(elements, e -> concat(e.other_station, ':', e.travel_time))) AS elements"
    return chunks.selectExpr(FILE, FILE_NAME, MONTH, STATION, "role", "chunk", "CAST(size(elements) AS BIGINT) AS length", shown)


def _split_lists(spark: SparkSession, sf_dir: str, rounded: bool = False) -> DataFrame:
    return op.split_connection_lists(op.connection_lists(_ends(spark, sf_dir)), rounded=rounded)


def _labels_only(query: Query) -> Query:
    """The tables here have one file per month, so the label tells files apart
    and the results are compared without the path."""
    return lambda spark, sf_dir: query(spark, sf_dir).drop(FILE)


_QUERIES: dict[str, Query] = {
    # sources and projections
    "scan_trip_files": _scan_trip_files,
    "scan_mixed_layout": _mixed_layout,
    "rejected_lines": _rejected_lines,
    "parse_trip_json": lambda s, d: parse_trip_json(trip_records_json(_trips(s, d))),
    "project_trips": lambda s, d: project_trips(trip_records_from_lineitem(s, d), with_user=False),
    "project_trips_with_user": lambda s, d: project_trips(trip_records_from_lineitem(s, d)),
    "month_label": lambda s, d: _trips(s, d)
    .groupBy(month_label(FILE_NAME).alias(MONTH))
    .agg(F.count(F.lit(1)).alias("trips")),
    "filter_annual": _annual,
    "trip_ends": _ends,
    # per-file station measures
    "avg_time_from": lambda s, d: op.avg_time_from(_trips(s, d)),
    "avg_time_from_rounded": lambda s, d: op.avg_time_from(_trips(s, d), rounded=True),
    "avg_time_to": lambda s, d: op.avg_time_to(_trips(s, d)),
    "avg_time_to_rounded": lambda s, d: op.avg_time_to(_trips(s, d), rounded=True),
    "connections_all": lambda s, d: op.connections(_ends(s, d)),
    "connections_annual": lambda s, d: op.connections(_annual_ends(s, d)),
    "connection_lists": lambda s, d: op.connection_lists(_ends(s, d)),
    "connection_list_chunks": _list_chunks,
    "split_connection_lists": _split_lists,
    "split_connection_lists_rounded": lambda s, d: _split_lists(s, d, rounded=True),
    "list_role_means": lambda s, d: op.list_role_means(_split_lists(s, d)),
    "list_role_means_rounded": lambda s, d: op.list_role_means(_split_lists(s, d), rounded=True),
    "role_means_raw": lambda s, d: op.role_means(_ends(s, d), rounded=False),
    "role_means_rounded": lambda s, d: op.role_means(_ends(s, d), rounded=True),
    "connections_time_raw": lambda s, d: op.connections_with_time(_ends(s, d), rounded=False),
    "connections_time_rounded": lambda s, d: op.connections_with_time(_ends(s, d), rounded=True),
    "station_times_join": lambda s, d: op.station_times_join(_trips(s, d), rounded=True),
    "station_times_join_raw": lambda s, d: op.station_times_join(_trips(s, d), rounded=False),
    "station_times_raw": lambda s, d: op.station_times(_ends(s, d), rounded=False),
    "station_times_rounded": lambda s, d: op.station_times(_ends(s, d), rounded=True),
    "station_times_annual": lambda s, d: op.station_times(_annual_ends(s, d), rounded=True),
    "union_months": _union_months,
    "stream_connections": _stream_connections,
    "refreshed_connections": _refreshed_connections,
    "compacted_connections": _compacted_connections,
    "running_totals": _running_totals,
    # per-file rankings (Q1, Q3, Q7, Q2, Q4, Q8)
    "top_times_raw": lambda s, d: reports.top_times(_trips(s, d), user_type=None, rounded=False),
    "top_times_rounded": lambda s, d: reports.top_times(_trips(s, d), user_type=None, rounded=True),
    "top_times_annual": lambda s, d: reports.top_times(_trips(s, d), user_type=1, rounded=True),
    "top_connections_time_raw": lambda s, d: reports.top_connections_time(
        _trips(s, d), user_type=None, rounded=False
    ),
    "top_connections_time_rounded": lambda s, d: reports.top_connections_time(
        _trips(s, d), user_type=None, rounded=True
    ),
    "top_connections_annual": lambda s, d: reports.top_connections(_trips(s, d), user_type=1),
    # totals over all files (Q5, Q6, Q9, Q10)
    "total_connections_all": lambda s, d: reports.total_connections_report(
        _trips(s, d), user_type=None, with_time=True
    ),
    "total_times_all": lambda s, d: reports.total_times_report(_trips(s, d), user_type=None),
    "total_connections_annual": lambda s, d: reports.total_connections_report(
        _trips(s, d), user_type=1, with_time=False
    ),
    "total_times_annual": lambda s, d: reports.total_times_report(_trips(s, d), user_type=1),
    # reports over stored JSON files (written, scanned, reported)
    "json_top_connections_annual": lambda s, d: reports.top_connections(_scan_trip_files(s, d), user_type=1),
    "json_total_connections_all": lambda s, d: reports.total_connections_report(
        _scan_trip_files(s, d), user_type=None, with_time=True
    ),
}
QUERIES: dict[str, Query] = {name: _labels_only(query) for name, query in _QUERIES.items()}


# --- SQL oracles ----------------------------------------------------------------

_TRIPS = """trips AS (
  SELECT strftime(l_shipdate, '%Y%m') AS file_name,
         strftime(l_shipdate, '%Y%m') AS month,
         CAST(l_quantity AS BIGINT) AS travel_time,
         l_suppkey % 50 AS origin,
         l_partkey % 60 AS destination,
         CAST(l_linenumber AS BIGINT) AS user_type
  FROM lineitem)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _ends_cte(source: str) -> str:
    return f"""ends AS (
  SELECT file_name, month, origin AS station, destination AS other_station,
         travel_time, 'origin' AS role FROM {source}
  UNION ALL
  SELECT file_name, month, destination AS station, origin AS other_station,
         travel_time, 'destination' AS role FROM {source})"""


_ANNUAL = "annual AS (SELECT * FROM trips WHERE user_type = 1)"


# Each half of the lists counted from the trips on its own.
_SPLIT = """split AS (
  SELECT file_name, month, origin AS station, 'leaving' AS side, destination AS other_station, travel_time, count(*) AS n
  FROM trips GROUP BY ALL
  UNION ALL
  SELECT file_name, month, destination AS station, 'reaching' AS side, origin AS other_station, travel_time, count(*) AS n
  FROM trips GROUP BY ALL)"""


def _rnd(expr: str) -> str:
    return f"CAST(round_even({expr}, 0) AS BIGINT)"


def _direction_means(source: str, rounded: bool) -> str:
    """Time table as the join of departure and arrival means (CTE ``times``)."""
    tf = _rnd("f.t") if rounded else "f.t"
    tt = _rnd("d.t") if rounded else "d.t"
    return f"""f AS (SELECT file_name, month, origin AS station, avg(travel_time) AS t
      FROM {source} GROUP BY file_name, month, origin),
d AS (SELECT file_name, month, destination AS station, avg(travel_time) AS t
      FROM {source} GROUP BY file_name, month, destination),
times AS (
  SELECT f.file_name, f.month, f.station, {tf} AS time_from, {tt} AS time_to
  FROM f JOIN d ON f.file_name = d.file_name AND f.month = d.month
               AND f.station IS NOT DISTINCT FROM d.station)"""


def _role_means_cte(rounded: bool) -> str:
    """Connection-list path over ``ends`` (CTE ``rm``)."""
    if rounded:
        t = "round_even(CAST(travel_time AS DOUBLE), 0)"
        tf = _rnd(f"avg({t}) FILTER (WHERE role = 'origin')")
        tt = _rnd(f"avg({t}) FILTER (WHERE role = 'destination')")
    else:
        tf = "avg(travel_time) FILTER (WHERE role = 'origin')"
        tt = "avg(travel_time) FILTER (WHERE role = 'destination')"
    return f"""rm AS (
  SELECT file_name, month, station, count(*) AS connections,
         {tf} AS time_from, {tt} AS time_to
  FROM ends GROUP BY file_name, month, station)"""


_MID = "(time_from + time_to) / CAST(2 AS DOUBLE)"


def _top_per_file(table: str, score: str, cols: str, k: int = 10) -> str:
    return f"""SELECT file_name, month, CAST(rn AS INTEGER) AS rank, {cols}
FROM (SELECT *, row_number() OVER (PARTITION BY file_name
        ORDER BY {score} DESC NULLS LAST, station ASC NULLS FIRST) AS rn
      FROM {table}) x
WHERE rn <= {k}"""


def _conn_cte(source_ends: str = "ends") -> str:
    return f"""conn AS (SELECT file_name, month, station, count(*) AS connections
  FROM {source_ends} GROUP BY file_name, month, station)"""


def _total_times(source: str) -> str:
    return (
        _with(_TRIPS, *([_ANNUAL] if source == "annual" else []), _direction_means(source, True))
        + f"""SELECT * FROM (
  SELECT station, {_rnd('avg(time_from)')} AS time_from, {_rnd('avg(time_to)')} AS time_to
  FROM times GROUP BY station) tot
ORDER BY {_MID} DESC NULLS LAST, station ASC NULLS FIRST
LIMIT 20"""
    )


ORACLE_SQL: dict[str, str] = {
    "scan_trip_files": _with(_TRIPS)
    + "SELECT * FROM trips",
    "parse_trip_json": _with(_TRIPS) + "SELECT * FROM trips",
    "project_trips": _with(_TRIPS)
    + "SELECT file_name, month, travel_time, origin, destination FROM trips",
    "project_trips_with_user": _with(_TRIPS) + "SELECT * FROM trips",
    "month_label": _with(_TRIPS)
    + "SELECT substr(file_name, 1, 6) AS month, count(*) AS trips FROM trips GROUP BY 1",
    "filter_annual": _with(_TRIPS, _ANNUAL) + "SELECT * FROM annual",
    "trip_ends": _with(_TRIPS, _ends_cte("trips")) + "SELECT * FROM ends",
    "avg_time_from": _with(_TRIPS)
    + """SELECT file_name, month, origin AS station, avg(travel_time) AS time_from
FROM trips GROUP BY file_name, month, origin""",
    "avg_time_from_rounded": _with(_TRIPS)
    + f"""SELECT file_name, month, origin AS station, {_rnd('avg(travel_time)')} AS time_from
FROM trips GROUP BY file_name, month, origin""",
    "avg_time_to": _with(_TRIPS)
    + """SELECT file_name, month, destination AS station, avg(travel_time) AS time_to
FROM trips GROUP BY file_name, month, destination""",
    "avg_time_to_rounded": _with(_TRIPS)
    + f"""SELECT file_name, month, destination AS station, {_rnd('avg(travel_time)')} AS time_to
FROM trips GROUP BY file_name, month, destination""",
    "connections_all": _with(_TRIPS, _ends_cte("trips"), _conn_cte()) + "SELECT * FROM conn",
    "connections_annual": _with(_TRIPS, _ANNUAL, _ends_cte("annual"), _conn_cte())
    + "SELECT * FROM conn",
    "connection_lists": _with(_TRIPS, _ends_cte("trips"))
    + """SELECT file_name, month, station, role, other_station, travel_time, count(*) AS n
FROM ends GROUP BY file_name, month, station, role, other_station, travel_time""",
    "connection_list_chunks": _with(_TRIPS, _ends_cte("trips"))
    + f"""SELECT file_name, month, station, role, chunk, count(*) AS length,
       string_agg(other_station || ':' || travel_time, ',' ORDER BY place) AS elements
FROM (SELECT *, (place - 1) // {_CHUNK_SIZE} AS chunk
      FROM (SELECT *, row_number() OVER (PARTITION BY file_name, month, station, role ORDER BY other_station, travel_time) AS place FROM ends))
GROUP BY file_name, month, station, role, chunk""",
    "split_connection_lists": _with(_TRIPS, _SPLIT) + "SELECT * FROM split",
    "split_connection_lists_rounded": _with(_TRIPS, _SPLIT)
    + "SELECT * REPLACE (CAST(round_even(travel_time, 0) AS BIGINT) AS travel_time) FROM split",
    "list_role_means": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(False))
    + "SELECT * FROM rm",
    "list_role_means_rounded": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(True))
    + "SELECT * FROM rm",
    "role_means_raw": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(False))
    + "SELECT * FROM rm",
    "role_means_rounded": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(True))
    + "SELECT * FROM rm",
    "connections_time_raw": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(False))
    + f"SELECT file_name, month, station, connections, {_MID} AS mean_time FROM rm",
    "connections_time_rounded": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(True))
    + f"SELECT file_name, month, station, connections, {_MID} AS mean_time FROM rm",
    "station_times_join": _with(_TRIPS, _direction_means("trips", True)) + "SELECT * FROM times",
    "station_times_join_raw": _with(_TRIPS, _direction_means("trips", False)) + "SELECT * FROM times",
    "station_times_raw": _with(_TRIPS, _direction_means("trips", False)) + "SELECT * FROM times",
    "station_times_rounded": _with(_TRIPS, _direction_means("trips", True))
    + "SELECT * FROM times",
    "station_times_annual": _with(_TRIPS, _ANNUAL, _direction_means("annual", True))
    + "SELECT * FROM times",
    "union_months": _with(_TRIPS, _ANNUAL, _direction_means("annual", True))
    + "SELECT * FROM times",
    "stream_connections": _with(_TRIPS, _ends_cte("trips"))
    + "SELECT month, station, count(*) AS connections FROM ends GROUP BY month, station",
    "top_times_raw": _with(_TRIPS, _direction_means("trips", False))
    + _top_per_file("times", _MID, "station, time_from, time_to"),
    "top_times_rounded": _with(_TRIPS, _direction_means("trips", True))
    + _top_per_file("times", _MID, "station, time_from, time_to"),
    "top_times_annual": _with(_TRIPS, _ANNUAL, _direction_means("annual", True))
    + _top_per_file("times", _MID, "station, time_from, time_to"),
    "top_connections_time_raw": _with(
        _TRIPS,
        _ends_cte("trips"),
        _role_means_cte(False),
        f"ct AS (SELECT file_name, month, station, connections, {_MID} AS mean_time FROM rm)",
    )
    + _top_per_file("ct", "connections", "station, connections, mean_time"),
    "top_connections_time_rounded": _with(
        _TRIPS,
        _ends_cte("trips"),
        _role_means_cte(True),
        f"ct AS (SELECT file_name, month, station, connections, {_MID} AS mean_time FROM rm)",
    )
    + _top_per_file("ct", "connections", "station, connections, mean_time"),
    "top_connections_annual": _with(_TRIPS, _ANNUAL, _ends_cte("annual"), _conn_cte())
    + _top_per_file("conn", "connections", "station, connections"),
    "total_connections_all": _with(_TRIPS, _ends_cte("trips"), _role_means_cte(True))
    + f"""SELECT * FROM (
  SELECT station, {_rnd('avg(connections)')} AS connections,
         {_rnd(f'avg({_MID})')} AS mean_time
  FROM rm GROUP BY station) tot
ORDER BY connections DESC NULLS LAST, station ASC NULLS FIRST
LIMIT 20""",
    "total_times_all": _total_times("trips"),
    "total_connections_annual": _with(_TRIPS, _ANNUAL, _ends_cte("annual"), _conn_cte())
    + f"""SELECT * FROM (
  SELECT station, {_rnd('avg(connections)')} AS connections
  FROM conn GROUP BY station) tot
ORDER BY connections DESC NULLS LAST, station ASC NULLS FIRST
LIMIT 20""",
    "total_times_annual": _total_times("annual"),
}
ORACLE_SQL["json_top_connections_annual"] = ORACLE_SQL["top_connections_annual"]
ORACLE_SQL["json_total_connections_all"] = ORACLE_SQL["total_connections_all"]

ORACLE_SQL["scan_mixed_layout"] = _with(_TRIPS) + "SELECT month, travel_time, origin, destination, user_type FROM trips"

# The damage done to the lines of ``rejected_lines``, and what is said of it.
ORACLE_SQL["rejected_lines"] = _with(_TRIPS) + """SELECT month,
       CASE k WHEN 0 THEN line[:-2] WHEN 1 THEN replace(line, '"travel_time":', '"travel_time":"x","t":')
              ELSE replace(line, 'idplug_station', 'station') END AS line,
       CASE k WHEN 0 THEN 'malformed' WHEN 1 THEN 'wrong type: travel_time' ELSE 'lacks: idplug_station' END AS reason
FROM (SELECT month, (7 * travel_time + 13 * origin + destination) % 97 AS k,
             '{"travel_time":' || travel_time || ',"idunplug_station":' || origin || ',"idplug_station":' || destination || ',"user_type":' || user_type || '}' AS line
      FROM trips) x
WHERE k < 3"""
_KEPT = f"kept AS (SELECT * FROM trips WHERE month IS DISTINCT FROM '{_REMOVED}')"
ORACLE_SQL["refreshed_connections"] = _with(_TRIPS, _KEPT, _ends_cte("kept"), _conn_cte()) + "SELECT * FROM conn"
ORACLE_SQL["compacted_connections"] = ORACLE_SQL["refreshed_connections"]
ORACLE_SQL["running_totals"] = _with(_TRIPS, _KEPT, _ends_cte("kept"), _role_means_cte(True), _direction_means("kept", True)) + f"""
SELECT a.station, a.connections, a.mean_time, b.time_from, b.time_to
FROM (SELECT station, {_rnd('avg(connections)')} AS connections, {_rnd(f'avg({_MID})')} AS mean_time FROM rm GROUP BY station) a
LEFT JOIN (SELECT station, {_rnd('avg(time_from)')} AS time_from, {_rnd('avg(time_to)')} AS time_to FROM times GROUP BY station) b
  ON a.station IS NOT DISTINCT FROM b.station"""
