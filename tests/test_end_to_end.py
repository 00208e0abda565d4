"""The production path end to end: trips stored as monthly JSON Lines
files, read back by the command line for each variant, give the same
reports as the registered queries on the table (which are checked against
SQL), whether a file is stored in one part or in many."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF001
from stationflow.__main__ import main
from stationflow.plans import run_variant
from stationflow.sources import new_shared_folder, read_trip_files, trips_from_lineitem, write_trip_files

KEYS = {
    "v1": {"top_times": "top_times_raw", "top_connections": "top_connections_time_raw"},
    "v2": {
        "top_times": "top_times_rounded",
        "top_connections": "top_connections_time_rounded",
        "total_connections": "total_connections_all",
        "total_times": "total_times_all",
    },
    "v3": {
        "top_times": "top_times_annual",
        "top_connections": "top_connections_annual",
        "total_connections": "total_connections_annual",
        "total_times": "total_times_annual",
    },
}


@pytest.fixture(scope="module")
def trip_folder(spark):
    folder = new_shared_folder(spark, "e2e-trips")
    write_trip_files(trips_from_lineitem(spark, SF001), folder)
    return folder


def _set(df):
    cols = [c for c in df.columns if c != "file"]  # the path
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("variant", ["v1", "v2", "v3"])
def test_cli_on_files_equals_registered_queries(spark, trip_folder, tmp_path, variant):
    out = str(tmp_path / variant)
    assert main([trip_folder, "--variant", variant, "--glob", "*.json", "--output", out]) == 0
    for report, key in KEYS[variant].items():
        got = spark.read.parquet(f"{out}/{report}")
        want = entry.queries()[key](spark, SF001)
        assert _set(got) == _set(want), (variant, report)


def test_a_file_in_many_parts_is_one_observation(spark, tmp_path):
    folder = str(tmp_path / "parts")
    small = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(small, "4KB")
    try:
        write_trip_files(trips_from_lineitem(spark, SF001).repartition(8), folder)
    finally:
        spark.conf.unset(small)
    files = spark.read.json(folder).inputFiles()
    trips = read_trip_files(spark, folder)
    assert len(files) > 2 * trips.select("file").distinct().count()
    for variant, reports in KEYS.items():
        with run_variant(trips, variant) as got:
            for report, key in reports.items():
                assert _set(got[report]) == _set(entry.queries()[key](spark, SF001)), (variant, report)


def test_closed_run_leaves_no_file(spark, tmp_path):
    import os

    from stationflow.plans import run as module

    base = tmp_path / "shared"
    base.mkdir()
    given, module.new_shared_folder = module.new_shared_folder, lambda s, prefix: f"file://{base}/{prefix}"
    try:
        with run_variant(trips_from_lineitem(spark, SF001), "v3") as reports:
            assert reports["top_times"].count() > 0 and os.listdir(base)
        assert os.listdir(base) == []
    finally:
        module.new_shared_folder = given
