"""The user-facing reports, composed from the operators.

Three variants of the analysis exist and give different numbers:

* ``v1`` – per-file rankings on unrounded means, all users, no totals;
* ``v2`` – half-even rounded means, month labels, totals over all files;
* ``v3`` – as v2 for annual-pass users only, connections without times.

Each report is one lazy plan: one scan, the user filter pushed to it, one
aggregation per file and station, then a per-file window or a second
(small) aggregation for the totals. Every report also has an ``*_of`` form
that starts from an existing per-file station table (:func:`station_stats`
output, for example a checkpointed or streamed one) instead of trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationflow.functions.columns import midpoint_sql
from stationflow.operators.ends import filter_user_type, trip_ends
from stationflow.operators.rank import top_k, top_k_per_file
from stationflow.operators.stations import (
    connections_of,
    connections_with_time_of,
    station_stats,
    station_times_of,
)
from stationflow.operators.totals import total_connections, total_times
from stationflow.schema import (
    CONNECTIONS,
    FILE,
    FILE_NAME,
    GRAIN,
    MEAN_TIME,
    MONTH,
    ORIGINAL_CONNECTIONS,
    ORIGINAL_MEAN_TIME,
    ORIGINAL_MONTH,
    ORIGINAL_STATION,
    ORIGINAL_TIME_FROM,
    ORIGINAL_TIME_TO,
    ORIGINAL_TOTAL_CONNECTIONS,
    RANK,
    STATION,
    TIME_FROM,
    TIME_TO,
    TOP_PER_FILE,
    TOP_TOTAL,
)


def _stats(trips: DataFrame, user_type: int | None) -> DataFrame:
    return station_stats(trip_ends(filter_user_type(trips, user_type)))


TIME_SCORE = midpoint_sql(TIME_FROM, TIME_TO)


# --- per-file rankings --------------------------------------------------------


def top_times_of(stats: DataFrame, *, rounded: bool, k: int = TOP_PER_FILE) -> DataFrame:
    times = station_times_of(stats, rounded=rounded)
    return top_k_per_file(times, TIME_SCORE, k).select(
        *GRAIN, RANK, STATION, TIME_FROM, TIME_TO
    )


def top_times(
    trips: DataFrame, *, user_type: int | None = None, rounded: bool = True, k: int = TOP_PER_FILE
) -> DataFrame:
    """Per file, the k stations with the longest mean time of use
    (midpoint of mean departure and mean arrival time).
    ``file, file_name, month, rank, station, time_from, time_to``."""
    return top_times_of(_stats(trips, user_type), rounded=rounded, k=k)


def top_connections_time_of(stats: DataFrame, *, rounded: bool, k: int = TOP_PER_FILE) -> DataFrame:
    table = connections_with_time_of(stats, rounded=rounded)
    return top_k_per_file(table, CONNECTIONS, k).select(
        *GRAIN, RANK, STATION, CONNECTIONS, MEAN_TIME
    )


def top_connections_time(
    trips: DataFrame, *, user_type: int | None = None, rounded: bool = True, k: int = TOP_PER_FILE
) -> DataFrame:
    """Per file, the k stations with most connections, with their mean time.
    ``file, file_name, month, rank, station, connections, mean_time``."""
    return top_connections_time_of(_stats(trips, user_type), rounded=rounded, k=k)


def top_connections_of(stats: DataFrame, *, k: int = TOP_PER_FILE) -> DataFrame:
    return top_k_per_file(connections_of(stats), CONNECTIONS, k).select(
        *GRAIN, RANK, STATION, CONNECTIONS
    )


def top_connections(trips: DataFrame, *, user_type: int | None = 1, k: int = TOP_PER_FILE) -> DataFrame:
    """Per file, the k stations with most connections.
    ``file, file_name, month, rank, station, connections``."""
    return top_connections_of(_stats(trips, user_type), k=k)


# --- totals over all files ----------------------------------------------------


def total_connections_report_of(stats: DataFrame, *, with_time: bool, k: int = TOP_TOTAL) -> DataFrame:
    per_file = (
        connections_with_time_of(stats, rounded=True) if with_time else connections_of(stats)
    )
    totals = total_connections(per_file, with_time=with_time)
    return top_k(totals, CONNECTIONS, k)


def total_connections_report(
    trips: DataFrame, *, user_type: int | None = 1, with_time: bool = False, k: int = TOP_TOTAL
) -> DataFrame:
    """The k stations with the highest mean connections per file
    (``station, connections[, mean_time]``)."""
    return total_connections_report_of(_stats(trips, user_type), with_time=with_time, k=k)


def total_times_report_of(stats: DataFrame, *, k: int = TOP_TOTAL) -> DataFrame:
    totals = total_times(station_times_of(stats, rounded=True))
    return top_k(totals, TIME_SCORE, k)


def total_times_report(trips: DataFrame, *, user_type: int | None = 1, k: int = TOP_TOTAL) -> DataFrame:
    """The k stations with the longest mean time of use over all files
    (``station, time_from, time_to``)."""
    return total_times_report_of(_stats(trips, user_type), k=k)


# --- the report sets of each variant ----------------------------------------

VARIANTS = {
    "v1": {"user_type": None, "rounded": False, "with_time": True, "totals": False},
    "v2": {"user_type": None, "rounded": True, "with_time": True, "totals": True},
    "v3": {"user_type": 1, "rounded": True, "with_time": False, "totals": True},
}


def variant_reports(
    stats: DataFrame,
    variant: str = "v3",
    *,
    k_file: int = TOP_PER_FILE,
    k_total: int = TOP_TOTAL,
) -> dict[str, DataFrame]:
    """All reports of one variant from one per-file station table.

    ``stats`` is :func:`station_stats` over the variant's trips (user filter
    already applied); see :func:`stationflow.plans.run.run_variant`."""
    v = VARIANTS[variant]
    out = {"top_times": top_times_of(stats, rounded=v["rounded"], k=k_file)}
    if v["with_time"]:
        out["top_connections"] = top_connections_time_of(stats, rounded=v["rounded"], k=k_file)
    else:
        out["top_connections"] = top_connections_of(stats, k=k_file)
    if v["totals"]:
        out["total_connections"] = total_connections_report_of(
            stats, with_time=v["with_time"], k=k_total
        )
        out["total_times"] = total_times_report_of(stats, k=k_total)
    return out


# --- the original table layout ------------------------------------------------

_ORIGINAL = {
    STATION: ORIGINAL_STATION,
    TIME_FROM: ORIGINAL_TIME_FROM,
    TIME_TO: ORIGINAL_TIME_TO,
    MEAN_TIME: ORIGINAL_MEAN_TIME,
    MONTH: ORIGINAL_MONTH,
}


def ordered(df: DataFrame) -> DataFrame:
    """A report in display order: per-file rankings by file and rank (the
    totals are already in rank order)."""
    if RANK in df.columns:
        return df.orderBy(*[c for c in (FILE_NAME, FILE) if c in df.columns], RANK)
    return df


def original_layout(df: DataFrame) -> DataFrame:
    """A report with the column names and order of the original printed
    tables: per-file tables end with the month column, ``file_name`` and
    ``rank`` are dropped (order by them first if the order matters), the
    totals keep only the station and its values."""
    per_file = MONTH in df.columns
    conn_name = ORIGINAL_CONNECTIONS if per_file else ORIGINAL_TOTAL_CONNECTIONS
    names = {**_ORIGINAL, CONNECTIONS: conn_name}
    order = [c for c in (STATION, CONNECTIONS, TIME_FROM, TIME_TO, MEAN_TIME, MONTH) if c in df.columns]
    return df.select(*[df[c].alias(names[c]) for c in order])
