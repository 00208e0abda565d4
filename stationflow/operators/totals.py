"""Totals over all files: the second level of a two-level aggregation.

A total is the mean of a station's per-file values over the files in which
it appears in that per-file table (a file without the station does not
count as zero), rounded half-even. The per-file values are already rounded,
so rounding happens at both levels. Trips are never pooled across files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.columns import half_even_sql
from stationflow.schema import CONNECTIONS, MEAN_TIME, STATION, TIME_FROM, TIME_TO


def _mean_rounded(col: str):
    return F.expr(f"{half_even_sql(f'avg({col})')} AS {col}")


def total_connections(per_file: DataFrame, *, with_time: bool = False) -> DataFrame:
    """``station, connections[, mean_time]``, BIGINT, from a per-file
    connection table (with ``mean_time`` when ``with_time``)."""
    cols = [CONNECTIONS] + ([MEAN_TIME] if with_time else [])
    return per_file.groupBy(STATION).agg(*[_mean_rounded(c) for c in cols])


def total_times(per_file: DataFrame) -> DataFrame:
    """``station, time_from, time_to``, BIGINT, from a per-file time table."""
    return per_file.groupBy(STATION).agg(_mean_rounded(TIME_FROM), _mean_rounded(TIME_TO))


def union_months(*per_file: DataFrame) -> DataFrame:
    """Stack per-file tables computed separately (for example, a stored
    table of past months and this month's new one) by column name."""
    if not per_file:
        raise ValueError("union_months needs at least one table")
    return reduce(lambda a, b: a.unionByName(b), per_file)
