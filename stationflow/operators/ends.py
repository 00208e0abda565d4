"""Trip filters and the unpivot of a trip into its two station ends."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationflow.schema import (
    ANNUAL_USER_TYPE,
    DESTINATION,
    FILE,
    FILE_NAME,
    MONTH,
    ORIGIN,
    OTHER_STATION,
    ROLE,
    ROLE_DESTINATION,
    ROLE_ORIGIN,
    STATION,
    TRAVEL_TIME,
    USER_TYPE,
)


def filter_user_type(trips: DataFrame, user_type: int | None = ANNUAL_USER_TYPE) -> DataFrame:
    """Keep the trips of one user type (1 = annual pass); ``None`` keeps all.

    Applied once, upstream of every measure, so Parquet sources get it as a
    pushed-down filter."""
    if user_type is None:
        return trips
    return trips.where(f"{USER_TYPE} = {int(user_type)}")


# One generator call turns a trip into its two ends in the scan stage: no
# second scan, no union, and no per-trip array to build. ``travel_time``
# stays outside the generator so that reports which do not use it (the
# connection counts) do not read it at all: a generator's outputs cannot be
# pruned.
_BOTH_ENDS = (
    f"stack(2, {ORIGIN}, {DESTINATION}, '{ROLE_ORIGIN}', {DESTINATION}, {ORIGIN}, '{ROLE_DESTINATION}')"
    f" AS ({STATION}, {OTHER_STATION}, {ROLE})"
)


def identified(trips: DataFrame) -> DataFrame:
    """Trips with the identity of their file; tables that only name their
    files (no ``file`` column) are told apart by that name."""
    return trips if FILE in trips.columns else trips.withColumn(FILE, trips[FILE_NAME])


def trip_ends(trips: DataFrame) -> DataFrame:
    """Two rows per trip: the origin end and the destination end.

    ``station`` is the station of this end, ``other_station`` the station at
    the other end, ``role`` says which end it is. A trip from a station to
    itself gives two ends at that station.
    ``file, file_name, month, station, other_station, travel_time, role``."""
    return identified(trips).selectExpr(FILE, FILE_NAME, MONTH, TRAVEL_TIME, _BOTH_ENDS).select(
        FILE, FILE_NAME, MONTH, STATION, OTHER_STATION, TRAVEL_TIME, ROLE
    )
