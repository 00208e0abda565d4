"""Station flow analytics on Spark.

Reads bike-share trip files, turns every trip into its two station ends,
and ranks stations per file and over all files by connections and by mean
time of use. Every function takes and returns DataFrames; nothing runs
until an action is called on a result."""

from stationflow import functions, operators, plans, sources, streaming
from stationflow.plans import (
    run_variant,
    top_connections,
    top_connections_time,
    top_times,
    total_connections_report,
    total_times_report,
)
from stationflow.sources import read_trip_files, trips_from_lineitem

__all__ = [
    "functions",
    "operators",
    "plans",
    "read_trip_files",
    "run_variant",
    "sources",
    "streaming",
    "top_connections",
    "top_connections_time",
    "top_times",
    "total_connections_report",
    "total_times_report",
    "trips_from_lineitem",
]
