"""Folders that hold plain files and files in parts side by side."""

from __future__ import annotations

import os

import pytest
from conftest import FIXTURE_FILES, write_files
from stationflow import operators as op
from stationflow.sources import read_trip_files
from stationflow.sources.manifest import trip_file_manifest
from stationflow.streaming import read_trip_stream, start_incremental_stats, stored_station_stats


def _mixed(folder):
    """One file plain, one in two parts, one plain in a second folder; files of
    other subfolders and hidden ones beside them."""
    names = list(FIXTURE_FILES)
    write_files(folder / "a b", {names[0]: FIXTURE_FILES[names[0]], "_hidden.json": ["no trip"], "notes.txt": ["no trip"]})
    write_files(folder / "a b" / f"file={names[1]}", {"part-0.json": FIXTURE_FILES[names[1]][:1], "part-1.json": FIXTURE_FILES[names[1]][1:]})
    write_files(folder / "a b" / "other", {"201912_x.json": ["no trip"]})
    write_files(folder / "c", {names[2]: FIXTURE_FILES[names[2]]})
    return [str(folder / "a b"), str(folder / "c")]


def _trips(df):
    return sorted((r.file_name, r.month, r.travel_time, r.origin, r.destination, r.user_type) for r in df.collect())


def _want(names=FIXTURE_FILES):
    return sorted((n, n[:6], *r) for n in names for r in FIXTURE_FILES[n])


def test_both_layouts_are_read(spark, tmp_path):
    paths = _mixed(tmp_path)
    trips = read_trip_files(spark, paths)
    assert _trips(trips) == _want()  # a line of a file that doesn't count would fail the scan
    assert trips.select("file").distinct().count() == 3  # parts are one file
    # the same as all files plain
    plain = write_files(tmp_path / "plain", FIXTURE_FILES)
    report = ["file_name", "station", "connections", "time_from", "time_to"]
    stats = [sorted(map(tuple, op.station_stats(op.trip_ends(read_trip_files(spark, p))).select(*report).collect())) for p in (paths, plain)]
    assert stats[0] == stats[1]


def test_one_file_a_pattern_and_relative_paths(spark, tmp_path, monkeypatch):
    paths = _mixed(tmp_path)
    names = list(FIXTURE_FILES)
    assert _trips(read_trip_files(spark, f"{paths[0]}/{names[0]}")) == _want(names[:1])
    assert _trips(read_trip_files(spark, f"{paths[0]}/file={names[1]}")) == _want(names[1:2])
    assert _trips(read_trip_files(spark, f"{tmp_path}/*")) == _want()
    assert _trips(read_trip_files(spark, f"file://{paths[1]}/")) == _want(names[2:])


def test_other_subfolders_do_not_count(spark, tmp_path):
    write_files(tmp_path / "in", {"notes.txt": ["x"]})
    write_files(tmp_path / "in" / "old", FIXTURE_FILES)
    with pytest.raises(ValueError, match="matches"):
        read_trip_files(spark, str(tmp_path / "in"))


def test_manifest(spark, tmp_path):
    paths = _mixed(tmp_path)
    got = {(r.file.rsplit("/", 1)[1], os.path.basename(r.path), r.length) for r in trip_file_manifest(spark, paths, glob="*.json").collect()}
    names = list(FIXTURE_FILES)
    assert {(f, b) for f, b, _ in got} == {(names[0], names[0]), (f"file={names[1]}", "part-0.json"), (f"file={names[1]}", "part-1.json"), (names[2], names[2])}
    assert all(n > 0 for *_, n in got)
    assert {r.file for r in trip_file_manifest(spark, paths, glob="*.json").collect()} == {r.file for r in read_trip_files(spark, paths).select("file").distinct().collect()}


def test_stream_reads_both_layouts(spark, tmp_path):
    folder = _mixed(tmp_path)[0]
    table, ckpt = str(tmp_path / "stats"), str(tmp_path / "ckpt")
    q = start_incremental_stats(read_trip_stream(spark, folder, max_files_per_trigger=1), table, ckpt, available_now=True)
    assert q.awaitTermination(120)
    batch = op.station_stats(op.trip_ends(read_trip_files(spark, folder)))
    stored = stored_station_stats(spark, table).select(*batch.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect())) and {r.file_name for r in stored.collect()} == set(list(FIXTURE_FILES)[:2])
