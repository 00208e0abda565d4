"""Data model of the trip analysis: record schema, column names, fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match:
# the JSON field names of a trip record in the monthly usage files, the user
# type of an annual pass, the length of the month label taken from a file
# name, the file suffix that is read, and the report sizes.
# ---------------------------------------------------------------------------
FIELD_TRAVEL_TIME = "travel_time"
FIELD_ORIGIN = "idunplug_station"
FIELD_DESTINATION = "idplug_station"
FIELD_USER_TYPE = "user_type"
ANNUAL_USER_TYPE = 1
MONTH_LABEL_LENGTH = 6
TRIP_FILE_GLOB = "*.json"
TRIP_FILE_GLOBS = {"json": TRIP_FILE_GLOB, "parquet": "*.parquet"}
TOP_PER_FILE = 10
TOP_TOTAL = 20

# The column headers of the original printed tables, for the
# optional original layout of the reports. The per-file tables say
# "Numero_Conexiones", the totals "Numero_conexiones".
ORIGINAL_STATION = "Estación"
ORIGINAL_TIME_FROM = "Tiempo_Origen"
ORIGINAL_TIME_TO = "Tiempo_Destino"
ORIGINAL_MONTH = "Mes"
ORIGINAL_CONNECTIONS = "Numero_Conexiones"
ORIGINAL_TOTAL_CONNECTIONS = "Numero_conexiones"
ORIGINAL_MEAN_TIME = "Tiempo_Medio"

# Roles of a station within one trip (ASCII names of the rebuild).
ROLE_ORIGIN = "origin"
ROLE_DESTINATION = "destination"

# Column names used throughout the package.
FILE = "file"
FILE_NAME = "file_name"
MONTH = "month"
TRAVEL_TIME = "travel_time"
ORIGIN = "origin"
DESTINATION = "destination"
USER_TYPE = "user_type"
STATION = "station"
OTHER_STATION = "other_station"
ROLE = "role"
CONNECTIONS = "connections"
TIME_FROM = "time_from"
TIME_TO = "time_to"
MEAN_TIME = "mean_time"
RANK = "rank"

# One input file is one observation (the grain of every per-file table). Its
# identity is ``file``: the whole path, or the path up to ``file=<name>`` when
# the file is stored in parts. ``file_name`` (the last step of that path) and
# ``month`` (its first six characters) are labels derived from it; the trips'
# own label columns are for filtering trips only.
GRAIN = (FILE, FILE_NAME, MONTH)
LABELS = (FILE_NAME, MONTH)

# The four fields of a trip record that the analysis reads; the JSON parser
# skips the rest.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField(FIELD_TRAVEL_TIME, T.LongType()),
        T.StructField(FIELD_ORIGIN, T.LongType()),
        T.StructField(FIELD_DESTINATION, T.LongType()),
        T.StructField(FIELD_USER_TYPE, T.LongType()),
    ]
)

# Schema of projected trips that tell their files apart by name; trips read
# from files also carry ``file``.
TRIPS_SCHEMA = T.StructType(
    [
        T.StructField(FILE_NAME, T.StringType()),
        T.StructField(MONTH, T.StringType()),
        T.StructField(TRAVEL_TIME, T.LongType()),
        T.StructField(ORIGIN, T.LongType()),
        T.StructField(DESTINATION, T.LongType()),
        T.StructField(USER_TYPE, T.LongType()),
    ]
)
