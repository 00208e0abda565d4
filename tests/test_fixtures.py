"""Hand-computed expectations on the small fixture (cases F-1 .. F-10)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import FIXTURE_FILES, rows, trip_line, write_files
from stationflow import operators as op
from stationflow import plans
from stationflow.sources import parse_trip_json, read_trip_files

U, X = "201801_usage.json", "201802_usage.json"
E = "201802_extra.json"


def _ends(trips, user_type=None):
    return op.trip_ends(op.filter_user_type(trips, user_type))


def test_scan_labels_and_projection(fixture_trips):
    assert fixture_trips.columns == ["file", "file_name", "month", "travel_time", "origin", "destination", "user_type"]
    got = rows(fixture_trips.groupBy("file_name", "month").count(), "file_name", "month", "count")
    assert got == sorted([(E, "201802", 2), (U, "201801", 7), (X, "201802", 3)])


def test_f1_self_loop_counts_twice(fixture_trips):
    conn = op.connections(_ends(fixture_trips))
    got = {(r.file_name, r.station): r.connections for r in conn.collect()}
    assert got[(U, 1)] == 7 and got[(U, 2)] == 5 and got[(U, 3)] == 1 and got[(U, 4)] == 1
    # every file: sum of connections is twice its trips
    per_file = conn.groupBy("file_name").agg(F.sum("connections").alias("s")).collect()
    assert {r.file_name: r.s for r in per_file} == {
        name: 2 * len(trips) for name, trips in FIXTURE_FILES.items()
    }


def test_f2_one_sided_stations(fixture_trips):
    ends = _ends(fixture_trips)
    times = op.station_times(ends, rounded=False)
    assert {(r.file_name, r.station) for r in times.collect()} == {
        (U, 1), (U, 2), (X, 1), (X, 2), (E, 1), (E, 2)
    }
    ct = {(r.file_name, r.station): r for r in op.connections_with_time(ends, rounded=True).collect()}
    assert ct[(U, 3)].connections == 1 and ct[(U, 3)].mean_time is None
    assert ct[(U, 4)].connections == 1 and ct[(U, 4)].mean_time is None


def test_f3_half_even(fixture_trips):
    times = op.station_times(_ends(fixture_trips), rounded=True)
    got = rows(times, "file_name", "station", "time_from", "time_to")
    assert got == sorted([
        (E, 1, 9, 12), (E, 2, 12, 9),
        (U, 1, 11, 39), (U, 2, 33, 12),  # 12.5 -> 12
        (X, 1, 40, 6), (X, 2, 6, 40),  # 5.5 -> 6
    ])


def test_raw_times(fixture_trips):
    raw = {(r.file_name, r.station): (r.time_from, r.time_to)
           for r in op.station_times(_ends(fixture_trips)).collect()}
    assert raw[(U, 1)] == pytest.approx((32 / 3, 39.25))
    assert raw[(U, 2)] == pytest.approx((100 / 3, 12.5))
    assert raw[(X, 1)] == pytest.approx((40.0, 5.5))


def test_f4_midpoints(fixture_trips):
    ends = _ends(fixture_trips)
    raw = {(r.file_name, r.station): r.mean_time for r in op.connections_with_time(ends).collect()}
    assert raw[(U, 1)] == pytest.approx(24.958333333)
    assert raw[(U, 2)] == pytest.approx(22.916666667)
    rnd = {(r.file_name, r.station): r.mean_time
           for r in op.connections_with_time(ends, rounded=True).collect()}
    assert rnd[(U, 1)] == 25.0 and rnd[(U, 2)] == 22.5 and rnd[(X, 1)] == 23.0 and rnd[(E, 1)] == 10.5


def test_f5_file_grain_in_totals(fixture_trips):
    tot = plans.total_connections_report(fixture_trips, user_type=None, with_time=True)
    got = rows(tot, "station", "connections", "mean_time")
    # station 1: mean(7, 3, 2) = 4 over three files (by month label: mean(7, 5) = 6)
    assert got == [(1, 4, 20), (2, 3, 19), (3, 1, None), (4, 1, None)]
    v3 = plans.total_connections_report(fixture_trips, user_type=None, with_time=False)
    assert v3.columns == ["station", "connections"]
    times = plans.total_times_report(fixture_trips, user_type=None)
    assert [tuple(r) for r in times.collect()] == [(1, 20, 19), (2, 17, 20)]


def test_f6_annual_users(fixture_trips):
    ends = _ends(fixture_trips, 1)
    conn = {(r.file_name, r.station): r.connections for r in op.connections(ends).collect()}
    assert conn[(U, 1)] == 6 and conn[(U, 2)] == 3 and (U, 4) not in conn
    times = {(r.file_name, r.station): (r.time_from, r.time_to)
             for r in op.station_times(ends, rounded=True).collect()}
    assert times[(U, 1)] == (11, 42) and times[(U, 2)] == (20, 12)
    tot = plans.total_connections_report(fixture_trips, user_type=1, with_time=True)
    assert rows(tot, "station", "connections", "mean_time") == [(1, 4, 20), (2, 3, 16), (3, 1, None)]
    tt = plans.total_times_report(fixture_trips, user_type=1)
    assert [tuple(r) for r in tt.collect()] == [(1, 20, 20), (2, 13, 20)]


def test_f7_ties_break_on_station(fixture_trips):
    top = plans.top_times(fixture_trips, user_type=None, rounded=True)
    x = sorted((r["rank"], r.station) for r in top.where(F.col("file_name") == X).collect())
    assert x == [(1, 1), (2, 2)]
    topc = plans.top_connections(fixture_trips, user_type=None)
    x = sorted((r["rank"], r.station, r.connections) for r in topc.where(F.col("file_name") == X).collect())
    assert x == [(1, 1, 3), (2, 2, 3)]


def test_top_k_cut(fixture_trips):
    top = plans.top_connections(fixture_trips, user_type=None, k=2)
    got = rows(top, "file_name", "rank", "station", "connections")
    assert got == sorted([(E, 1, 1, 2), (E, 2, 2, 2), (U, 1, 1, 7), (U, 2, 2, 5), (X, 1, 1, 3), (X, 2, 2, 3)])


def test_f8_file_selection_and_names(spark, tmp_path):
    folder = write_files(tmp_path / "f8", {
        **FIXTURE_FILES,
        "notes.txt": ["this is not json"],
        "201803_usage.json": [],
        "2018 1_u.json": [(1, 1, 2, 1)],
        "2018+1_u.json": [(2, 1, 2, 1)],
        "2018%1_u.json": [(3, 1, 2, 1)],
        "2018ñ_u.json": [(4, 1, 2, 1)],
    })
    trips = read_trip_files(spark, folder)
    labels = rows(trips.groupBy("file_name", "month").count(), "file_name", "month", "count")
    assert ("2018 1_u.json", "2018 1", 1) in labels
    assert ("2018+1_u.json", "2018+1", 1) in labels
    assert ("2018%1_u.json", "2018%1", 1) in labels
    assert ("2018ñ_u.json", "2018ñ_", 1) in labels  # six characters, not bytes
    assert all(not name.startswith("notes") and not name.startswith("201803") for name, _, _ in labels)
    # an empty file gives no rows and no failure in the reports
    assert plans.top_times(trips, user_type=None).where(F.col("month") == "201803").count() == 0


def test_f8_without_glob_reads_every_file(spark, tmp_path):
    folder = write_files(tmp_path / "f8b", {"a.json": [(1, 1, 2, 1)], "b.txt": [(2, 1, 2, 1)]})
    assert read_trip_files(spark, folder).count() == 1
    assert read_trip_files(spark, folder, glob=None).count() == 2


def test_f9_nulls_and_bad_input(spark, tmp_path):
    folder = write_files(tmp_path / "f9", {
        "201801_usage.json": [
            (10, 1, 2, 1),
            (20, None, 2, 1),      # NULL origin: a station of its own
            (None, 1, 2, 1),       # NULL time: counted, not averaged
            (30, None, None, 1),
        ],
    })
    trips = read_trip_files(spark, folder)
    ends = op.trip_ends(trips)
    conn = {r.station: r.connections for r in op.connections(ends).collect()}
    assert conn == {1: 2, 2: 3, None: 3}
    rm = {r.station: (r.time_from, r.time_to) for r in op.role_means(ends).collect()}
    assert rm[1] == (10.0, None) and rm[None] == (25.0, 30.0)
    # the literal join matches NULL stations like the single-pass form
    join = rows(op.station_times_join(trips), "station", "time_from", "time_to")
    single = rows(op.station_times(ends), "station", "time_from", "time_to")
    assert join == single == [(None, 25.0, 30.0)]

    missing = write_files(tmp_path / "f9m", {"201801_usage.json": ['{"travel_time": 5, "idunplug_station": 1, "idplug_station": 2}']})
    assert read_trip_files(spark, missing).collect()[0].user_type is None
    with pytest.raises(Exception, match="lacks field"):
        read_trip_files(spark, missing, strict=True).collect()

    bad = write_files(tmp_path / "f9b", {"201801_usage.json": [(1, 1, 2, 1), "{not json"]})
    with pytest.raises(Exception):
        read_trip_files(spark, bad).collect()
    assert read_trip_files(spark, bad, mode="DROPMALFORMED").count() == 1


def test_f10_rounded_list_path_with_fractional_times(spark):
    schema = T.StructType([
        T.StructField("file_name", T.StringType()), T.StructField("month", T.StringType()),
        T.StructField("travel_time", T.DoubleType()), T.StructField("origin", T.LongType()),
        T.StructField("destination", T.LongType()), T.StructField("user_type", T.LongType()),
    ])
    trips = spark.createDataFrame([
        ("f.json", "f.json"[:6], 0.5, 1, 2, 1),
        ("f.json", "f.json"[:6], 2.5, 1, 2, 1),
        ("f.json", "f.json"[:6], 2.5, 1, 2, 1),
        ("f.json", "f.json"[:6], 3.5, 2, 1, 1),
    ], schema)
    ends = op.trip_ends(trips)
    # connection path rounds every trip: (0 + 2 + 2) / 3 = 1.33 -> 1
    rm = {r.station: (r.time_from, r.time_to) for r in op.role_means(ends, rounded=True).collect()}
    assert rm[1] == (1, 4)
    # time path averages raw times: 5.5 / 3 = 1.83 -> 2
    st = {r.station: (r.time_from, r.time_to) for r in op.station_times(ends, rounded=True).collect()}
    assert st[1] == (2, 4)
    raw = {r.station: r.time_from for r in op.station_times(ends).collect()}
    assert raw[1] == pytest.approx(5.5 / 3) and raw[2] == 3.5


def test_json_text_column_parse(spark):
    lines = spark.createDataFrame(
        [("a.json", "a.json", '{"travel_time": 3, "idunplug_station": 4, "idplug_station": 5, "user_type": 1, "zip_code": "1"}')],
        "file_name string, month string, value string",
    )
    got = parse_trip_json(lines).collect()[0]
    assert (got.travel_time, got.origin, got.destination, got.user_type) == (3, 4, 5, 1)


def test_parquet_trip_files_match_json(spark, fixture_dir, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "pq"
    os.makedirs(folder)
    for name, trips in FIXTURE_FILES.items():
        cols = list(zip(*trips))
        table = pa.table({
            "travel_time": pa.array(cols[0], pa.int64()),
            "idunplug_station": pa.array(cols[1], pa.int64()),
            "idplug_station": pa.array(cols[2], pa.int64()),
            "user_type": pa.array(cols[3], pa.int64()),
            "zip_code": pa.array(["00000"] * len(trips)),
        })
        pq.write_table(table, folder / name.replace(".json", ".parquet"))
    from_parquet = read_trip_files(spark, str(folder), fmt="parquet", glob="*.parquet").withColumns(
        {c: F.regexp_replace(c, "[.]parquet$", ".json") for c in ("file", "file_name")}
    )
    from_json = read_trip_files(spark, fixture_dir)
    cols = [c for c in from_json.columns if c != "file"]
    assert rows(from_parquet, *cols) == rows(from_json, *cols)
    assert rows(plans.top_times(from_parquet, user_type=1), "file_name", "rank", "station") == rows(
        plans.top_times(from_json, user_type=1), "file_name", "rank", "station"
    )


def test_reader_options_pass_through(spark, tmp_path):
    folder = tmp_path / "latin"
    folder.mkdir()
    (folder / "201801_usage.json").write_bytes(
        '{"travel_time": 7, "idunplug_station": 1, "idplug_station": 2, "user_type": 1, "zip_code": "café"}\n'.encode("latin-1")
    )
    trips = read_trip_files(spark, str(folder), options={"encoding": "ISO-8859-1", "lineSep": "\n"})
    assert [tuple(r) for r in trips.select("travel_time", "origin", "destination").collect()] == [(7, 1, 2)]


def test_empty_folder_gives_empty_reports(spark, tmp_path):
    folder = write_files(tmp_path / "empty", {})
    trips = read_trip_files(spark, folder)
    assert trips.count() == 0
    for variant in ("v1", "v2", "v3"):
        for name, df in plans.run_variant(trips, variant, materialize=False).items():
            assert df.count() == 0, (variant, name)


def test_several_folders_in_one_scan(spark, tmp_path):
    a = write_files(tmp_path / "a", {U: FIXTURE_FILES[U]})
    b = write_files(tmp_path / "b", {X: FIXTURE_FILES[X], E: FIXTURE_FILES[E]})
    both = read_trip_files(spark, [a, b])
    one = read_trip_files(spark, write_files(tmp_path / "all", FIXTURE_FILES))
    assert rows(both, *both.columns[1:]) == rows(one, *one.columns[1:])


def test_json_text_column_strict_and_failfast(spark):
    lines = spark.createDataFrame(
        [("a.json", "a.json", '{"travel_time": 3, "idunplug_station": 4, "idplug_station": 5}')],
        "file_name string, month string, value string",
    )
    assert parse_trip_json(lines).collect()[0].user_type is None
    with pytest.raises(Exception, match="lacks field"):
        parse_trip_json(lines, strict=True).collect()
    bad = spark.createDataFrame([("a.json", "a.json", "{not json")], "file_name string, month string, value string")
    with pytest.raises(Exception):
        parse_trip_json(bad).collect()


def test_files_of_one_name_in_two_folders_are_two_observations(spark, tmp_path):
    a = write_files(tmp_path / "a", {U: FIXTURE_FILES[U]})
    b = write_files(tmp_path / "b", {U: FIXTURE_FILES[U]})
    one = op.connections(_ends(read_trip_files(spark, a)))
    two = op.connections(_ends(read_trip_files(spark, [a, b])))
    assert two.count() == 2 * one.count() and two.select("file").distinct().count() == 2
    assert rows(two, "file_name", "station", "connections") == sorted(2 * rows(one, "file_name", "station", "connections"))
    top = plans.top_connections(read_trip_files(spark, [a, b]), user_type=None, k=1)
    assert [r["connections"] for r in top.collect()] == [7, 7]


def test_folder_without_matching_file_is_an_error(spark, tmp_path):
    folder = write_files(tmp_path / "text", {"notes.txt": ["nothing here"]})
    with pytest.raises(ValueError, match="matches"):
        read_trip_files(spark, folder)


def test_strict_checks_fields_that_the_report_does_not_use(spark, tmp_path):
    lacks = write_files(tmp_path / "lacks", {U: [trip_line(..., 1, 2, 1)]})
    wrong = write_files(tmp_path / "wrong", {U: [trip_line("abc", 1, 2, 1)]})
    assert plans.top_connections(read_trip_files(spark, lacks)).count() == 2
    for folder in (lacks, wrong):
        with pytest.raises(Exception, match="lacks field|MALFORMED|Malformed|CANNOT_PARSE"):
            plans.top_connections(read_trip_files(spark, folder, strict=True)).collect()


def test_loose_scan_reads_only_the_fields_of_the_report(spark, fixture_dir):
    def plan(strict):
        df = plans.top_connections(read_trip_files(spark, fixture_dir, strict=strict))
        return df._jdf.queryExecution().executedPlan().toString()

    assert "travel_time" not in plan(False) and "travel_time" in plan(True)
