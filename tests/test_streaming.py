"""The incremental path: files landing in a folder, one micro-batch at a
time, give the same per-file station table and reports as one batch scan."""

from __future__ import annotations

from conftest import FIXTURE_FILES, write_files
from stationflow import operators as op
from stationflow import plans
from stationflow.sources import read_trip_files
from stationflow.streaming import read_trip_stream, start_incremental_stats, stored_station_stats


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def _run(spark, files, table, ckpt, user_type=None):
    stream = read_trip_stream(spark, files, max_files_per_trigger=1)
    q = start_incremental_stats(stream, table, ckpt, user_type=user_type, available_now=True)
    assert q.awaitTermination(120)
    q.stop()
    spark.streams.resetTerminated()
    return q


def test_stream_equals_batch_and_is_incremental(spark, tmp_path):
    files = write_files(tmp_path / "in", FIXTURE_FILES)
    table, ckpt = str(tmp_path / "stats"), str(tmp_path / "ckpt")
    q = _run(spark, files, table, ckpt)
    assert q.lastProgress is not None
    batch = op.station_stats(op.trip_ends(read_trip_files(spark, files)))
    stored = stored_station_stats(spark, table).select(*batch.columns)
    assert _set(stored) == _set(batch)

    # a new month arrives: only the new file is processed on the next run
    write_files(tmp_path / "in", {"201803_usage.json": [(8, 1, 2, 1), (4, 2, 1, 1)]})
    _run(spark, files, table, ckpt)
    stored = stored_station_stats(spark, table)
    assert stored.where("file_name = '201803_usage.json'").count() == 2
    assert stored.count() == batch.count() + 2

    # the reports on the stored table equal the reports of one batch scan
    trips = read_trip_files(spark, files)
    for variant in ("v1", "v2"):
        from_stream = plans.variant_reports(stored.select(*batch.columns), variant)
        from_batch = plans.run_variant(trips, variant, materialize=False)
        for name, df in from_batch.items():
            assert _set(from_stream[name]) == _set(df), (variant, name)


def test_stream_user_filter(spark, tmp_path):
    files = write_files(tmp_path / "in", FIXTURE_FILES)
    table, ckpt = str(tmp_path / "stats"), str(tmp_path / "ckpt")
    _run(spark, files, table, ckpt, user_type=1)
    stored = stored_station_stats(spark, table)
    batch = op.station_stats(op.trip_ends(op.filter_user_type(read_trip_files(spark, files), 1)))
    assert _set(stored.select(*batch.columns)) == _set(batch)


def test_replayed_batch_does_not_duplicate(spark, tmp_path):
    """A crash after a batch wrote its table but before it committed: on
    restart the batch runs again with the same id and overwrites its slice."""
    import os

    files = write_files(tmp_path / "in", FIXTURE_FILES)
    table, ckpt = str(tmp_path / "stats"), str(tmp_path / "ckpt")
    _run(spark, files, table, ckpt)  # one file per batch: batches 0, 1, 2
    commits = sorted(int(n) for n in os.listdir(os.path.join(ckpt, "commits")) if n.isdigit())
    assert commits == [0, 1, 2]
    # batch 2 written, not committed (the commit and its local checksum file)
    for name in ("2", ".2.crc"):
        path = os.path.join(ckpt, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    before = os.path.getmtime(os.path.join(table, "batch=2"))
    _run(spark, files, table, ckpt)
    assert os.path.exists(os.path.join(ckpt, "commits", "2"))  # batch 2 ran again
    assert os.path.getmtime(os.path.join(table, "batch=2")) >= before
    batch = op.station_stats(op.trip_ends(read_trip_files(spark, files)))
    stored = stored_station_stats(spark, table).select(*batch.columns)
    assert _set(stored) == _set(batch)


def test_incremental_reports_equal_batch_reports(spark, tmp_path):
    from stationflow.streaming import start_incremental_reports

    files = write_files(tmp_path / "in", FIXTURE_FILES)
    reports_path = str(tmp_path / "reports")
    stream = read_trip_stream(spark, files, max_files_per_trigger=1)
    q = start_incremental_reports(
        stream, str(tmp_path / "stats"), reports_path, str(tmp_path / "ckpt"), variant="v2", available_now=True
    )
    assert q.awaitTermination(120)
    q.stop()
    spark.streams.resetTerminated()
    expected = plans.run_variant(read_trip_files(spark, files), "v2", materialize=False)
    for name, df in expected.items():
        assert _set(spark.read.parquet(f"{reports_path}/{name}").select(*df.columns)) == _set(df), name


def test_old_files_are_not_left_out(spark, tmp_path):
    """Archives copied with their times: a file a month older than the newest
    one seen still enters the table and the reports."""
    import os
    import time

    files = write_files(tmp_path / "in", {"201802_usage.json": [(5, 2, 1, 1)]})
    table, ckpt = str(tmp_path / "stats"), str(tmp_path / "ckpt")
    _run(spark, files, table, ckpt)
    write_files(tmp_path / "in", {"201801_usage.json": [(9, 1, 2, 1)]})
    old = time.time() - 30 * 86400
    os.utime(tmp_path / "in" / "201801_usage.json", (old, old))
    _run(spark, files, table, ckpt)
    assert {r["month"] for r in stored_station_stats(spark, table).collect()} == {"201801", "201802"}


def test_new_checkpoint_on_a_filled_table_is_refused(spark, tmp_path):
    import pytest

    files = write_files(tmp_path / "in", FIXTURE_FILES)
    table = str(tmp_path / "stats")
    _run(spark, files, table, str(tmp_path / "ckpt"))
    with pytest.raises(ValueError, match="another stream"):
        _run(spark, files, table, str(tmp_path / "fresh"))
    batch = op.station_stats(op.trip_ends(read_trip_files(spark, files)))
    assert _set(stored_station_stats(spark, table).select(*batch.columns)) == _set(batch)


def test_parts_of_a_file_in_several_batches_add_up(spark, tmp_path):
    from conftest import SF001

    from stationflow.sources import trips_from_lineitem, write_trip_files

    folder = str(tmp_path / "parts")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    try:
        write_trip_files(trips_from_lineitem(spark, SF001).where("month < '199505'").repartition(4), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stream = read_trip_stream(spark, folder, max_files_per_trigger=7)
    q = start_incremental_stats(stream, str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    assert q.awaitTermination(120)
    spark.streams.resetTerminated()
    batch = op.station_stats(op.trip_ends(read_trip_files(spark, folder)))
    assert _set(stored_station_stats(spark, str(tmp_path / "t")).select(*batch.columns)) == _set(batch)
