"""Per-file station measures: connections, mean travel times, and the
connection lists behind them.

All single-pass measures are projections of one aggregation,
:func:`station_stats`, grouped by file and station. Spark runs it as a
partial aggregation in every scan task and a final one after the shuffle,
so the shuffle carries one row per (task, file, station) whatever the number
of trips, and a station holding a large share of all trips costs no more to
shuffle than any other. Columns a query does not use are pruned from the
aggregation by Catalyst.

Per-file rows are grouped on ``file`` alone, the identity of the file: its
name and month label are parts of it, so they are derived after the
aggregation (fewer strings in every shuffled row, none built per trip). The
label columns of the trips are therefore not read here.
Carrying it through the aggregation instead (``any_value(month)``) puts a
string into the aggregation buffer, which takes Spark off its fast
fixed-width hash aggregation: measured 3-4x slower."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.columns import (
    DESTINATION_END_SQL,
    ORIGIN_END_SQL,
    file_name_sql,
    half_even_sql,
    half_even_value_sql,
    midpoint_sql,
    month_label_sql,
    when_sql,
)
from stationflow.operators.ends import identified
from stationflow.schema import (
    CONNECTIONS,
    DESTINATION,
    FILE,
    FILE_NAME,
    GRAIN,
    MEAN_TIME,
    MONTH,
    ORIGIN,
    OTHER_STATION,
    ROLE,
    ROLE_DESTINATION,
    ROLE_ORIGIN,
    STATION,
    TIME_FROM,
    TIME_TO,
    TRAVEL_TIME,
)

KEYS = (*GRAIN, STATION)

# Internal columns of station_stats.
N_FROM = "n_from"
N_TO = "n_to"
LIST_TIME_FROM = "list_time_from"
LIST_TIME_TO = "list_time_to"


def _labelled(grouped: DataFrame, *rest: str) -> DataFrame:
    named = grouped.selectExpr("*", f"{file_name_sql(FILE)} AS {FILE_NAME}")
    return named.selectExpr(FILE, FILE_NAME, f"{month_label_sql(FILE_NAME)} AS {MONTH}", *rest)


def _agg(*named_sql: tuple[str, str]) -> list[Column]:
    return [F.expr(f"{sql} AS {name}") for name, sql in named_sql]


def station_stats(ends: DataFrame) -> DataFrame:
    """One row per (file, station) with every statistic the reports need.

    ``connections``   ends at the station (a self-loop counts twice)
    ``n_from/n_to``   ends as origin / as destination
    ``time_from/to``  mean travel time of trips leaving / reaching it
    ``list_time_*``   the same means over trip times rounded half-even
                      first (the rounded connection-list path)
    A NULL station is a station of its own; a NULL travel time counts as a
    connection but is left out of the means."""
    rounded = half_even_value_sql(TRAVEL_TIME)
    stats = ends.groupBy(FILE, STATION).agg(
        *_agg(
            (CONNECTIONS, "count(1)"),
            (N_FROM, f"count({when_sql(ORIGIN_END_SQL, '1')})"),
            (N_TO, f"count({when_sql(DESTINATION_END_SQL, '1')})"),
            (TIME_FROM, f"avg({when_sql(ORIGIN_END_SQL, TRAVEL_TIME)})"),
            (TIME_TO, f"avg({when_sql(DESTINATION_END_SQL, TRAVEL_TIME)})"),
            (LIST_TIME_FROM, f"avg({when_sql(ORIGIN_END_SQL, rounded)})"),
            (LIST_TIME_TO, f"avg({when_sql(DESTINATION_END_SQL, rounded)})"),
        )
    )
    return _labelled(
        stats, STATION, CONNECTIONS, N_FROM, N_TO, TIME_FROM, TIME_TO, LIST_TIME_FROM, LIST_TIME_TO
    )


# --- the same measures in parts ------------------------------------------------

# Sums and counts per direction, and over trip times rounded first.
_SUMS = tuple(
    (f"{what}_{side}", f"{how}({when_sql(end, value)})")
    for side, end in (("from", ORIGIN_END_SQL), ("to", DESTINATION_END_SQL))
    for what, how, value in (
        ("n", "count", "1"),
        ("timed", "count", TRAVEL_TIME),
        ("sum", "sum", f"CAST({TRAVEL_TIME} AS DOUBLE)"),
        ("rounded_sum", "sum", f"CAST({half_even_value_sql(TRAVEL_TIME)} AS DOUBLE)"),
    )
)


def station_sums(ends: DataFrame) -> DataFrame:
    """Per (file, station), sums and counts from which :func:`station_stats`
    follows; tables of parts of a file add up."""
    return ends.groupBy(FILE, STATION).agg(*_agg((CONNECTIONS, "count(1)"), *_SUMS))


def merge_station_sums(sums: DataFrame) -> DataFrame:
    """Sums of all parts of each file."""
    names = [CONNECTIONS, *(name for name, _ in _SUMS)]
    return sums.groupBy(FILE, STATION).agg(*_agg(*((name, f"sum({name})") for name in names)))


def station_stats_of_sums(sums: DataFrame) -> DataFrame:
    """The rows of :func:`station_stats`."""
    stats = sums.selectExpr(
        FILE, STATION, CONNECTIONS, f"n_from AS {N_FROM}", f"n_to AS {N_TO}",
        f"try_divide(sum_from, timed_from) AS {TIME_FROM}", f"try_divide(sum_to, timed_to) AS {TIME_TO}",
        f"try_divide(rounded_sum_from, timed_from) AS {LIST_TIME_FROM}",
        f"try_divide(rounded_sum_to, timed_to) AS {LIST_TIME_TO}",
    )
    return _labelled(
        stats, STATION, CONNECTIONS, N_FROM, N_TO, TIME_FROM, TIME_TO, LIST_TIME_FROM, LIST_TIME_TO
    )


# --- projections of station_stats -------------------------------------------


def connections_of(stats: DataFrame) -> DataFrame:
    """Number of trip ends of every station, per file."""
    return stats.select(*KEYS, CONNECTIONS)


def station_times_of(stats: DataFrame, *, rounded: bool) -> DataFrame:
    """Mean departure and arrival time of stations that have both (a station
    with trips in one direction only has no time score)."""
    both = stats.where(f"{N_FROM} > 0 AND {N_TO} > 0")
    if rounded:
        return both.selectExpr(
            *KEYS,
            f"{half_even_sql(TIME_FROM)} AS {TIME_FROM}",
            f"{half_even_sql(TIME_TO)} AS {TIME_TO}",
        )
    return both.select(*KEYS, TIME_FROM, TIME_TO)


def role_means_of(stats: DataFrame, *, rounded: bool) -> DataFrame:
    """Connections and the per-role means of the connection-list path.

    Raw: plain means. Rounded: each trip time rounded, then the mean
    rounded. A station without trips in one direction keeps its row with
    that mean NULL."""
    if rounded:
        return stats.selectExpr(
            *KEYS,
            CONNECTIONS,
            f"{half_even_sql(LIST_TIME_FROM)} AS {TIME_FROM}",
            f"{half_even_sql(LIST_TIME_TO)} AS {TIME_TO}",
        )
    return stats.select(*KEYS, CONNECTIONS, TIME_FROM, TIME_TO)


def connections_with_time_of(stats: DataFrame, *, rounded: bool) -> DataFrame:
    """Connections and the midpoint of the two role means (DOUBLE; NULL when
    the station lacks one direction)."""
    means = role_means_of(stats, rounded=rounded)
    return means.selectExpr(*KEYS, CONNECTIONS, f"{midpoint_sql(TIME_FROM, TIME_TO)} AS {MEAN_TIME}")


# --- operators on trip ends --------------------------------------------------


def connections(ends: DataFrame) -> DataFrame:
    """``file, file_name, month, station, connections``: number of trip ends."""
    return connections_of(station_stats(ends))


def station_times(ends: DataFrame, *, rounded: bool = False) -> DataFrame:
    """``file, file_name, month, station, time_from, time_to`` in one pass: a
    conditional mean per direction in a single aggregation, no join."""
    return station_times_of(station_stats(ends), rounded=rounded)


def role_means(ends: DataFrame, *, rounded: bool = False) -> DataFrame:
    """``file, file_name, month, station, connections, time_from, time_to`` of the
    connection-list path, every station kept."""
    return role_means_of(station_stats(ends), rounded=rounded)


def connections_with_time(ends: DataFrame, *, rounded: bool = False) -> DataFrame:
    """``file, file_name, month, station, connections, mean_time``."""
    return connections_with_time_of(station_stats(ends), rounded=rounded)


# --- operators on trips: one direction at a time, and the literal join ------


def _avg_time(trips: DataFrame, by: str, name: str, rounded: bool) -> DataFrame:
    mean = half_even_sql(f"avg({TRAVEL_TIME})") if rounded else f"avg({TRAVEL_TIME})"
    grouped = identified(trips).groupBy(FILE, F.col(by).alias(STATION)).agg(*_agg((name, mean)))
    return _labelled(grouped, STATION, name)


def avg_time_from(trips: DataFrame, *, rounded: bool = False) -> DataFrame:
    """Mean travel time of the trips leaving each station, per file."""
    return _avg_time(trips, ORIGIN, TIME_FROM, rounded)


def avg_time_to(trips: DataFrame, *, rounded: bool = False) -> DataFrame:
    """Mean travel time of the trips reaching each station, per file."""
    return _avg_time(trips, DESTINATION, TIME_TO, rounded)


def station_times_join(trips: DataFrame, *, rounded: bool = False) -> DataFrame:
    """The time table as an inner join of the two direction means.

    Keys are compared null-safely, so a NULL station matches itself as in a
    plain grouping. Gives the same rows as :func:`station_times`, which
    avoids the join and its second aggregation. Both sides are per-file
    station tables (files x stations rows), so AQE sees their real size at
    run time and picks the join strategy."""
    left = avg_time_from(trips, rounded=rounded)
    right = avg_time_to(trips, rounded=rounded).select(
        *[F.col(c).alias(f"_r_{c}") for c in (FILE, STATION)], F.col(TIME_TO)
    )
    cond = [left[c].eqNullSafe(right[f"_r_{c}"]) for c in (FILE, STATION)]
    return left.join(right, cond, "inner").select(*KEYS, TIME_FROM, TIME_TO)


# --- connection lists ---------------------------------------------------------

MULTIPLICITY = "n"
SIDE = "side"
LEAVING, REACHING = "leaving", "reaching"


def connection_lists(ends: DataFrame) -> DataFrame:
    """The connection list of every station, kept distributed.

    A station's list is the multiset of ``(other_station, travel_time,
    role)`` over its trip ends. It is returned as one row per distinct
    element with its multiplicity ``n``:
    ``file, file_name, month, station, role, other_station, travel_time, n``.
    This loses nothing (``sum(n)`` is the list length, the connections) and
    never gathers a whole list into one task or row, which would not scale
    for a busy station."""
    grouped = ends.groupBy(FILE, STATION, ROLE, OTHER_STATION, TRAVEL_TIME).agg(
        *_agg((MULTIPLICITY, "count(1)"))
    )
    return _labelled(grouped, STATION, ROLE, OTHER_STATION, TRAVEL_TIME, MULTIPLICITY)


def split_connection_lists(lists: DataFrame, *, rounded: bool = False) -> DataFrame:
    """Split connection lists into the trips leaving the station and the
    trips reaching it: one table with the side of each row,
    ``file, file_name, month, station, side, other_station, travel_time, n``.

    The two halves stay in one table (take one with ``side = 'leaving'``), so
    the lists behind them are built once. ``rounded`` rounds every trip time
    half-even, as the rounded path does before it takes means."""
    side = f"CASE WHEN {ROLE} = '{ROLE_ORIGIN}' THEN '{LEAVING}' WHEN {ROLE} = '{ROLE_DESTINATION}' THEN '{REACHING}' END AS {SIDE}"
    time = f"{half_even_value_sql(TRAVEL_TIME)} AS {TRAVEL_TIME}" if rounded else TRAVEL_TIME
    return lists.selectExpr(*KEYS, side, OTHER_STATION, time, MULTIPLICITY)


def list_role_means(split: DataFrame, *, rounded: bool = False) -> DataFrame:
    """Per-direction mean over split connection lists:
    ``file, file_name, month, station, connections, time_from, time_to``, in
    one aggregation weighted by multiplicity. ``rounded`` rounds the trip
    times and the means."""
    t = half_even_value_sql(TRAVEL_TIME) if rounded else TRAVEL_TIME
    n = MULTIPLICITY

    def side_mean(which: str) -> str:
        on = f"{SIDE} = '{which}'"
        weighted = f"sum({when_sql(on, f'({t}) * {n}')})"
        timed = f"sum({when_sql(f'{on} AND ({t}) IS NOT NULL', n)})"
        mean = f"{weighted} / {timed}"
        return half_even_sql(mean) if rounded else mean

    grouped = split.groupBy(FILE, STATION).agg(
        *_agg((CONNECTIONS, f"sum({n})"), (TIME_FROM, side_mean(LEAVING)), (TIME_TO, side_mean(REACHING)))
    )
    return _labelled(grouped, STATION, CONNECTIONS, TIME_FROM, TIME_TO)


__all__ = [
    "avg_time_from",
    "avg_time_to",
    "connection_lists",
    "connections",
    "connections_of",
    "connections_with_time",
    "connections_with_time_of",
    "list_role_means",
    "merge_station_sums",
    "role_means",
    "role_means_of",
    "split_connection_lists",
    "station_stats",
    "station_stats_of_sums",
    "station_sums",
    "station_times",
    "station_times_join",
    "station_times_of",
]
