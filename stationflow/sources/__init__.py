from stationflow.sources.files import delete_folder, new_shared_folder, shared_dir, write_trip_files
from stationflow.sources.manifest import trip_file_manifest
from stationflow.sources.rejected import SplitTrips, judge_lines, rejected_counts, split_trip_files
from stationflow.sources.trips import (
    parse_trip_json,
    project_trips,
    read_trip_files,
    trip_file_glob,
    trip_records,
    trip_records_from_lineitem,
    trip_records_json,
    trips_from_lineitem,
)

__all__ = [
    "SplitTrips",
    "delete_folder",
    "judge_lines",
    "new_shared_folder",
    "parse_trip_json",
    "project_trips",
    "read_trip_files",
    "rejected_counts",
    "shared_dir",
    "split_trip_files",
    "trip_file_glob",
    "trip_file_manifest",
    "trip_records",
    "trip_records_from_lineitem",
    "trip_records_json",
    "trips_from_lineitem",
    "write_trip_files",
]
