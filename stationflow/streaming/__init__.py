from stationflow.streaming.incremental import (
    per_file_stats_writer,
    read_trip_stream,
    start_incremental_reports,
    start_incremental_stats,
    stored_station_stats,
    write_reports,
)
from stationflow.streaming.ledger import (
    compact_station_table,
    folder_changes,
    refresh_station_table,
    refreshed_station_stats,
    running_totals,
)
from stationflow.streaming.snapshots import publish_reports, published_reports

__all__ = [
    "compact_station_table",
    "folder_changes",
    "per_file_stats_writer",
    "publish_reports",
    "published_reports",
    "read_trip_stream",
    "refresh_station_table",
    "refreshed_station_stats",
    "running_totals",
    "start_incremental_reports",
    "start_incremental_stats",
    "stored_station_stats",
    "write_reports",
]
