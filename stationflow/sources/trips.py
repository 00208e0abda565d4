"""Trip sources: monthly trip files (JSON Lines or Parquet), JSON text
columns, and the trip view derived from the ``lineitem`` test table.

Every source returns the same projected trips schema
(``file, file_name, month, travel_time, origin, destination, user_type``) so that
all operators downstream are source-agnostic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.columns import complete_sql, file_key_sql, file_name_sql, month_label_sql
from stationflow.schema import (
    DESTINATION,
    FIELD_DESTINATION,
    FIELD_ORIGIN,
    FIELD_TRAVEL_TIME,
    FIELD_USER_TYPE,
    FILE,
    FILE_NAME,
    MONTH,
    ORIGIN,
    TRAVEL_TIME,
    TRIP_FILE_GLOBS,
    TRIP_SCHEMA,
    USER_TYPE,
)
from stationflow.sources.manifest import LISTED_THROUGH, belongs, input_roots, is_trip_file

_FIELDS = {
    TRAVEL_TIME: FIELD_TRAVEL_TIME,
    ORIGIN: FIELD_ORIGIN,
    DESTINATION: FIELD_DESTINATION,
    USER_TYPE: FIELD_USER_TYPE,
}


def project_trips(raw: DataFrame, *, with_user: bool = True, strict: bool = False) -> DataFrame:
    """Keep the trip fields under analysis names.

    ``raw`` holds the record fields (``travel_time``, ``idunplug_station``,
    ``idplug_station``, ``user_type``) plus ``file``, ``file_name``, ``month``.
    ``with_user=False`` is the three-field projection of the earlier
    variants. ``strict=True`` fails the job on a record that lacks any of
    the four fields, whichever of them the query uses, instead of carrying a
    NULL; the check is a filter over all of them, so it also makes the parser
    read (and, under ``FAILFAST``, reject) fields that the query does not use."""
    wanted = [TRAVEL_TIME, ORIGIN, DESTINATION] + ([USER_TYPE] if with_user else [])
    if strict:
        raw = raw.where(complete_sql(list(_FIELDS.values())))
    key = FILE if FILE in raw.columns else f"{FILE_NAME} AS {FILE}"
    return raw.selectExpr(key, FILE_NAME, MONTH, *[f"`{_FIELDS[n]}` AS {n}" for n in wanted])


_BY_FORMAT = "*by-format*"


def trip_file_glob(fmt: str, glob: str | None = _BY_FORMAT) -> str | None:
    """The name pattern to read: the given one, or the format's own."""
    if fmt not in TRIP_FILE_GLOBS:
        raise ValueError(f"unsupported trip file format: {fmt}")
    return TRIP_FILE_GLOBS[fmt] if glob == _BY_FORMAT else glob or None


def read_trip_files(
    spark: SparkSession,
    path: str | list[str],
    *,
    fmt: str = "json",
    glob: str | None = _BY_FORMAT,
    mode: str = "FAILFAST",
    strict: bool = False,
    with_user: bool = True,
    schema: T.StructType = TRIP_SCHEMA,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One scan of every trip file in ``path`` (a folder, or a list of
    folders read together).

    Each row carries the identity of its file (the grain of the analysis:
    files of one name in two folders are two observations), the file's name
    and the month label, the first six characters of that name. A file may
    also be stored in parts, as a directory ``file=<name>`` (see
    :func:`write_trip_files`); it is still one observation.
    ``glob`` keeps only matching file names (by default ``*.json``, or
    ``*.parquet`` for that format); ``None`` reads every file, as the first
    variant did. A folder whose files all fail the pattern is an error. Names
    that start with ``_`` or ``.`` are hidden files to Spark and never read.
    ``mode`` is the JSON parse mode: ``FAILFAST`` raises on a malformed line,
    in the fields that the query uses (in all four with ``strict``). Parquet files are read with the
    same record schema (``fmt="parquet"``). ``schema`` may widen a field
    type (for example a DOUBLE ``travel_time``) but keeps the field names.
    ``options`` go to the reader as they are (for example ``encoding``).
    A folder may hold plain files and ``file=<name>`` directories side by side;
    files of other subfolders are not read."""
    glob = trip_file_glob(fmt, glob)
    reader = spark.read.schema(schema).options(**LISTED_THROUGH, **(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [path] if isinstance(path, str) else list(path)
    roots = input_roots(spark, paths)
    if fmt == "json":
        raw = reader.option("mode", mode).json(paths)
    else:
        raw = reader.parquet(*paths)
    if glob and not _any_trip_file(roots, raw) and _any_trip_file(roots, spark.read.format("binaryFile").options(**LISTED_THROUGH).load(paths)):
        raise ValueError(f"no file in {', '.join(paths)} matches {glob}")
    return label_trip_records(raw.where(belongs(roots)), schema=schema, with_user=with_user, strict=strict)


def _any_trip_file(roots: list[str], scan: DataFrame) -> bool:
    return any(is_trip_file(roots, f) for f in scan.inputFiles())


def label_trip_records(
    raw: DataFrame, *, schema: T.StructType = TRIP_SCHEMA, with_user: bool = True, strict: bool = False
) -> DataFrame:
    """Trip records of a file scan (batch or streaming) labelled with the
    name of their file and its month, then projected."""
    keyed = raw.selectExpr(*[f"`{f}`" for f in schema.fieldNames()], f"{file_key_sql()} AS {FILE}")
    labelled = keyed.selectExpr("*", f"{file_name_sql(FILE)} AS {FILE_NAME}").selectExpr(
        "*", f"{month_label_sql(FILE_NAME)} AS {MONTH}"
    )
    return project_trips(labelled, with_user=with_user, strict=strict)


def parse_trip_json(
    lines: DataFrame,
    *,
    value: str = "value",
    mode: str = "FAILFAST",
    strict: bool = False,
    with_user: bool = True,
    schema: T.StructType = TRIP_SCHEMA,
) -> DataFrame:
    """Parse a column of JSON trip records (one object per row) in the plan.

    ``lines`` carries ``file``, ``file_name``, ``month`` and the text column ``value``
    (for example from a streaming source or a text table)."""
    rec = F.from_json(F.col(value), schema, {"mode": mode}).alias("r")
    if FILE not in lines.columns:  # files told apart by name only
        lines = lines.withColumn(FILE, F.col(FILE_NAME))
    parsed = lines.select(FILE, FILE_NAME, MONTH, rec).select(FILE, FILE_NAME, MONTH, "r.*")
    return project_trips(parsed, with_user=with_user, strict=strict)


def trip_records(trips: DataFrame) -> DataFrame:
    """Trips back as raw records: ``file_name`` and the trip fields under the
    field names of the files."""
    return trips.select(
        F.col(FILE_NAME), *[F.col(col).alias(field) for col, field in _FIELDS.items() if col in trips.columns]
    )


def trip_records_json(trips: DataFrame) -> DataFrame:
    """Trips back as JSON record text (``file, file_name, month, value``), with the
    field names of the raw files. Used to build JSON inputs from tables."""
    record = F.to_json(
        F.struct(*[F.col(col).alias(field) for col, field in _FIELDS.items() if col in trips.columns])
    )
    return trips.select(FILE, FILE_NAME, MONTH, record.alias("value"))


# Mapping of the ``lineitem`` test table onto trips (parameters of the test
# data, not of the analysis): stations 0..49 are departure stations and
# 0..59 arrival stations, so stations 50..59 only ever receive trips.
LINEITEM_ORIGINS = 50
LINEITEM_DESTINATIONS = 60


# Columns of ``lineitem`` the mapping reads. Giving the read schema up
# front prunes the scan and skips the footer-reading job of schema inference.
LINEITEM_TRIP_COLUMNS = T.StructType(
    [
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def trip_records_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip records (JSON field names) derived from ``lineitem``: one
    trip per line item.

    ``travel_time`` = quantity, origin station = supplier key mod 50,
    destination station = part key mod 60, ``user_type`` = line number.
    The table has no files, so the ship month (``yyyyMM``) stands for the
    monthly file: it is the file's identity, its name and its month label."""
    li = spark.read.schema(LINEITEM_TRIP_COLUMNS).parquet(f"{sf_dir}/lineitem.parquet")
    # Built from integer fields: cheaper per row than a date formatter.
    ym = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING)"
    return li.selectExpr(
        f"{ym} AS {FILE}",
        f"{ym} AS {FILE_NAME}",
        f"{ym} AS {MONTH}",
        f"CAST(l_quantity AS BIGINT) AS {FIELD_TRAVEL_TIME}",
        f"l_suppkey % {LINEITEM_ORIGINS} AS {FIELD_ORIGIN}",
        f"l_partkey % {LINEITEM_DESTINATIONS} AS {FIELD_DESTINATION}",
        f"CAST(l_linenumber AS BIGINT) AS {FIELD_USER_TYPE}",
    )


def trips_from_lineitem(spark: SparkSession, sf_dir: str, *, with_user: bool = True) -> DataFrame:
    """Projected trips derived from ``lineitem``."""
    return project_trips(trip_records_from_lineitem(spark, sf_dir), with_user=with_user)
