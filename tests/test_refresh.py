"""Rejected lines, folders that change, running totals, published reports."""

from __future__ import annotations

import os
import shutil

import pytest
from conftest import FIXTURE_FILES, trip_line, write_files
from stationflow import operators as op
from stationflow import plans
from stationflow.sources import read_trip_files, rejected_counts, split_trip_files
from stationflow.streaming import (
    compact_station_table,
    publish_reports,
    published_reports,
    read_trip_stream,
    refresh_station_table,
    refreshed_station_stats,
    running_totals,
    start_incremental_reports,
)
from stationflow.streaming import ledger

NAMES = list(FIXTURE_FILES)


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- rejected lines ---------------------------------------------------------------


def test_rejected_lines(spark, tmp_path):
    bad = {
        '{"travel_time": 1, "idunplug_station"': "malformed",
        "not a record": "malformed",
        trip_line("x", 1, 2, 1): "wrong type: travel_time",
        trip_line(1.5, 1, 2, 1): "wrong type: travel_time",
        trip_line(3, 1, 2, 1, user_type=...): "lacks: user_type",
        trip_line(3, 1, 2, 1, idplug_station=None): "lacks: idplug_station",
        "{}": "lacks: travel_time",
    }
    files = {NAMES[0]: [*FIXTURE_FILES[NAMES[0]], *list(bad)[:4], "", "  "], NAMES[1]: [*list(bad)[4:], *FIXTURE_FILES[NAMES[1]]], "201805_empty.json": []}
    folder = write_files(tmp_path / "in", files)
    write_files(tmp_path / "in" / f"file={NAMES[2]}", {"part-0.json": FIXTURE_FILES[NAMES[2]]})
    trips, rejected = split_trip_files(spark, folder)
    clean = read_trip_files(spark, write_files(tmp_path / "clean", FIXTURE_FILES))
    columns = [c for c in clean.columns if c != "file"]
    assert trips.columns == clean.columns and _set(trips.select(columns)) == _set(clean.select(columns))
    got = {(r.file_name, r.month, r.line): r.reason for r in rejected.collect()}
    assert got == {(NAMES[0] if i < 4 else NAMES[1], "201801" if i < 4 else "201802", line): reason for i, (line, reason) in enumerate(bad.items())}
    counts = {(r.file_name, r.reason): r.lines for r in rejected_counts(rejected).collect()}
    assert counts[NAMES[0], "malformed"] == 2 and sum(counts.values()) == len(bad)
    # the files may go: neither half reads them again
    shutil.rmtree(folder)
    assert trips.count() == clean.count() and rejected.count() == len(bad)


def test_no_lines_at_all(spark, tmp_path):
    trips, rejected = split_trip_files(spark, write_files(tmp_path / "in", {NAMES[0]: ["", " \t"]}))
    assert trips.count() == 0 and rejected.count() == 0


# --- folders that change ------------------------------------------------------------


def _same_as_batch(spark, folder, table, user_type=None):
    batch = op.station_stats(op.trip_ends(op.filter_user_type(read_trip_files(spark, folder), user_type)))
    assert _set(refreshed_station_stats(spark, table).select(*batch.columns)) == _set(batch)
    totals = {r.station: tuple(r) for r in running_totals(spark, table).collect()}
    connections = {r.station: (r.connections, r.mean_time) for r in op.total_connections(op.connections_with_time(op.trip_ends(op.filter_user_type(read_trip_files(spark, folder), user_type)), rounded=True), with_time=True).collect()}
    times = {r.station: (r.time_from, r.time_to) for r in op.total_times(op.station_times(op.trip_ends(op.filter_user_type(read_trip_files(spark, folder), user_type)), rounded=True)).collect()}
    assert totals == {s: (s, *c, *times.get(s, (None, None))) for s, c in connections.items()}


@pytest.mark.parametrize("user_type", [None, 1])
def test_new_changed_and_removed_files(spark, tmp_path, user_type):
    folder, table = write_files(tmp_path / "in [1]", {NAMES[0]: FIXTURE_FILES[NAMES[0]], NAMES[1]: FIXTURE_FILES[NAMES[1]][:1]}), str(tmp_path / "table")
    pattern = folder.replace("[", "\\[").replace("]", "\\]")

    def refresh():
        return refresh_station_table(spark, pattern, table, user_type=user_type)

    assert refresh() == {"read": 2, "gone": 0}
    _same_as_batch(spark, pattern, table, user_type)
    assert refresh() == {"read": 0, "gone": 0}
    write_files(folder, {NAMES[1]: FIXTURE_FILES[NAMES[1]]})  # delivered again, longer
    write_files(os.path.join(folder, f"file={NAMES[2]}"), {"part-0.json": FIXTURE_FILES[NAMES[2]][:1]})  # a part of a new one
    assert refresh() == {"read": 2, "gone": 0}
    _same_as_batch(spark, pattern, table, user_type)
    write_files(os.path.join(folder, f"file={NAMES[2]}"), {"part-1.json": FIXTURE_FILES[NAMES[2]][1:]})  # its late part
    os.remove(os.path.join(folder, NAMES[0]))
    assert refresh() == {"read": 1, "gone": 1}
    _same_as_batch(spark, pattern, table, user_type)
    write_files(folder, {NAMES[0]: FIXTURE_FILES[NAMES[0]]})  # back again
    assert refresh() == {"read": 1, "gone": 0}
    _same_as_batch(spark, pattern, table, user_type)


def test_a_killed_refresh_is_made_again(spark, tmp_path, monkeypatch):
    folder, table = write_files(tmp_path / "in", {NAMES[0]: FIXTURE_FILES[NAMES[0]]}), str(tmp_path / "table")
    refresh_station_table(spark, folder, table)
    before = _set(refreshed_station_stats(spark, table))
    write_files(folder, FIXTURE_FILES)
    real = ledger._totals
    monkeypatch.setattr(ledger, "_totals", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        refresh_station_table(spark, folder, table)  # dies after the sums, before the ledger
    assert _set(refreshed_station_stats(spark, table)) == before
    monkeypatch.setattr(ledger, "_totals", real)
    assert refresh_station_table(spark, folder, table)["read"] >= 2
    _same_as_batch(spark, folder, table)


def test_only_changed_files_are_opened(spark, tmp_path):
    """An unchanged file that became unreadable in place is not noticed."""
    folder, table = write_files(tmp_path / "in", FIXTURE_FILES), str(tmp_path / "table")
    refresh_station_table(spark, folder, table)
    path = os.path.join(folder, NAMES[0])
    stat = os.stat(path)
    with open(path, "r+b") as f:
        f.write(b"x")
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    write_files(folder, {"201803_new.json": [(4, 1, 2, 1)]})
    assert refresh_station_table(spark, folder, table) == {"read": 1, "gone": 0}
    assert refreshed_station_stats(spark, table).select("file").distinct().count() == 4


# --- compaction -----------------------------------------------------------------------


def test_slices_stay_few_per_order():
    """Two hundred refreshes of one or a few files, compacted after each."""
    slices = {}
    for run in range(1, 201):
        slices[2 * run] = 1 + run % 3
        chosen = ledger.slices_to_merge(slices, 4)
        if chosen:
            slices[2 * run + 1] = sum(slices.pop(s) for s in chosen)
        orders = [next(i for i in range(20) if n < 4 ** (i + 1)) for n in slices.values()]
        assert max(map(orders.count, orders)) < 4, (run, slices)
    assert sum(slices.values()) == sum(1 + run % 3 for run in range(1, 201))
    assert ledger.slices_to_merge({}) == [] and ledger.slices_to_merge({1: 5}, 2) == []


def test_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    folder, table, merged = str(tmp_path / "in"), str(tmp_path / "table"), []
    os.makedirs(folder)
    for i in range(9):
        write_files(folder, {f"2018{i + 1:02}_u.json": [(i + 1, 1, 2, 1), (i, 2, 3, 1)]})
        if i in (4, 6):
            os.remove(os.path.join(folder, f"2018{i:02}_u.json"))
        if i == 5:
            write_files(folder, {"201801_u.json": [(7, 1, 3, 1)]})  # delivered again
        refresh_station_table(spark, folder, table)
        before = _set(refreshed_station_stats(spark, table))
        if i == 1:  # killed after the merged sums, before the ledger
            monkeypatch.setattr(ledger, "_STATE", "no schema at all")
            with pytest.raises(Exception, match="(?i)parse|syntax"):
                compact_station_table(spark, table, fan_in=2)
            monkeypatch.undo()
            assert "run=3" in os.listdir(f"{table}/sums") and _set(refreshed_station_stats(spark, table)) == before
        planned = refreshed_station_stats(spark, table)
        merged.append(compact_station_table(spark, table, fan_in=2))
        assert _set(planned) == before == _set(refreshed_station_stats(spark, table))
        assert refresh_station_table(spark, folder, table) == {"read": 0, "gone": 0}
        _same_as_batch(spark, folder, table)
    assert merged[:2] == [0, 2] and sum(n > 0 for n in merged) >= 4
    stored = {part: len(os.listdir(os.path.join(table, part))) for part in ("sums", "totals", "ledger")}
    assert all(n <= 8 for n in stored.values()), stored
    with pytest.raises(ValueError, match="fan_in"):
        compact_station_table(spark, table, fan_in=1)


def test_a_gone_file_stays_gone(spark, tmp_path):
    folder, table = write_files(tmp_path / "in", FIXTURE_FILES), str(tmp_path / "table")
    refresh_station_table(spark, folder, table)
    os.remove(os.path.join(folder, NAMES[0]))
    for i in range(5):
        write_files(folder, {f"20190{i + 1}_n.json": [(4, 1, 2, 1)]})
        refresh_station_table(spark, folder, table)
        compact_station_table(spark, table, fan_in=2)
        _same_as_batch(spark, folder, table)
    write_files(folder, {NAMES[0]: FIXTURE_FILES[NAMES[0]]})
    assert refresh_station_table(spark, folder, table) == {"read": 1, "gone": 0}
    _same_as_batch(spark, folder, table)


# --- published reports ----------------------------------------------------------------


def test_a_set_of_reports_is_seen_whole(spark, tmp_path):
    base = str(tmp_path / "reports")
    assert published_reports(spark, base) == {}
    one, two = spark.range(3).toDF("a"), spark.range(5).toDF("a")
    first = publish_reports(spark, base, {"x": one, "y": one})
    broken = spark.range(3).selectExpr("raise_error('dies') AS a")
    with pytest.raises(Exception, match="dies"):
        publish_reports(spark, base, {"x": two, "y": broken})  # x is written, y is not
    assert {n: df.count() for n, df in published_reports(spark, base).items()} == {"x": 3, "y": 3}
    publish_reports(spark, base, {"x": two, "y": two})
    publish_reports(spark, base, {"x": two})
    assert {n: df.count() for n, df in published_reports(spark, base).items()} == {"x": 5}
    assert first not in os.listdir(os.path.join(base, "versions"))  # older ones go


def test_stream_publishes_versions(spark, tmp_path):
    folder = write_files(tmp_path / "in", FIXTURE_FILES)
    args = [str(tmp_path / x) for x in ("stats", "reports", "ckpt")]
    q = start_incremental_reports(read_trip_stream(spark, folder), *args, variant="v3", snapshots=True, available_now=True)
    assert q.awaitTermination(120)
    got = published_reports(spark, args[1])
    want = plans.run_variant(read_trip_files(spark, folder), "v3", materialize=False)
    assert got.keys() == dict(want.items()).keys()
    for name, df in want.items():
        assert _set(got[name].select(*df.columns)) == _set(df), name
