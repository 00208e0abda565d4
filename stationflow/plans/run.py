"""A whole analysis run: every report of a variant from a single scan.

The per-file station table is the only thing the reports share. It is
small (files x stations rows, independent of the number of trips), so it is
written once to the shared folder as Parquet and every report reads its own
columns from there. Writing it cuts the lineage back to the trip scan: losing
an executor afterwards never re-reads the trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationflow.operators.ends import filter_user_type, trip_ends
from stationflow.operators.stations import station_stats
from stationflow.plans.reports import VARIANTS, variant_reports
from stationflow.schema import TOP_PER_FILE, TOP_TOTAL
from stationflow.sources.files import delete_folder, new_shared_folder


class Reports(dict):
    """Reports by name, and the stored table behind them. ``close()`` (or
    leaving a ``with`` block) deletes that table once the reports were used."""

    def __init__(self, reports: dict[str, DataFrame], spark: SparkSession, stored: str | None) -> None:
        super().__init__(reports)
        self.spark, self.stored = spark, stored

    def close(self) -> None:
        if self.stored:
            delete_folder(self.spark, self.stored)
            self.stored = None

    def __enter__(self) -> Reports:
        return self

    def __exit__(self, *failure) -> None:
        self.close()


def materialized_stats(trips: DataFrame, folder: str, *, user_type: int | None) -> DataFrame:
    """:func:`station_stats` of the trips, written to ``folder`` in one scan."""
    stats = station_stats(trip_ends(filter_user_type(trips, user_type)))
    stats.write.parquet(folder)
    return trips.sparkSession.read.schema(stats.schema).parquet(folder)


def run_variant(
    trips: DataFrame,
    variant: str = "v3",
    *,
    k_file: int = TOP_PER_FILE,
    k_total: int = TOP_TOTAL,
    materialize: bool = True,
) -> Reports:
    """Reports of one variant (``top_times``, ``top_connections`` and, for
    v2/v3, ``total_connections`` and ``total_times``)."""
    spark = trips.sparkSession
    user_type = VARIANTS[variant]["user_type"]
    folder = new_shared_folder(spark, "station-stats") if materialize else None
    if folder:
        stats = materialized_stats(trips, folder, user_type=user_type)
    else:
        stats = station_stats(trip_ends(filter_user_type(trips, user_type)))
    return Reports(variant_reports(stats, variant, k_file=k_file, k_total=k_total), spark, folder)
