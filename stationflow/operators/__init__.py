from stationflow.operators.ends import filter_user_type, trip_ends
from stationflow.operators.list_chunks import connection_list_chunks
from stationflow.operators.rank import top_k, top_k_per_file
from stationflow.operators.stations import (
    avg_time_from,
    avg_time_to,
    connection_lists,
    connections,
    connections_of,
    connections_with_time,
    connections_with_time_of,
    list_role_means,
    merge_station_sums,
    role_means,
    role_means_of,
    split_connection_lists,
    station_stats,
    station_stats_of_sums,
    station_sums,
    station_times,
    station_times_join,
    station_times_of,
)
from stationflow.operators.totals import total_connections, total_times, union_months

__all__ = [
    "avg_time_from",
    "avg_time_to",
    "connection_list_chunks",
    "connection_lists",
    "connections",
    "connections_of",
    "connections_with_time",
    "connections_with_time_of",
    "filter_user_type",
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
    "top_k",
    "top_k_per_file",
    "total_connections",
    "total_times",
    "trip_ends",
    "union_months",
]
