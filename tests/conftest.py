from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Hand-sized fixture: rows are (travel_time, origin, destination, user_type).
FIXTURE_FILES = {
    "201801_usage.json": [
        (10, 1, 2, 1), (15, 1, 2, 1), (20, 2, 1, 1), (7, 1, 1, 1),
        (100, 3, 1, 1), (50, 2, 4, 2), (30, 2, 1, 2),
    ],
    "201802_usage.json": [(5, 2, 1, 1), (6, 2, 1, 1), (40, 1, 2, 1)],
    "201802_extra.json": [(9, 1, 2, 1), (12, 2, 1, 1)],
}


def trip_line(t, o, d, u, **extra) -> str:
    """One JSON trip record with every field; ``extra`` overrides fields,
    and a field given as ``...`` is left out of the record."""
    rec = {
        "_id": {"$oid": "000000000000000000000001"},
        "user_day_code": "0000000000000000",
        "idplug_base": 1,
        "user_type": u,
        "idunplug_base": 14,
        "travel_time": t,
        "idunplug_station": o,
        "ageRange": 5,
        "idplug_station": d,
        "unplug_hourTime": {"$date": "2018-01-01T00:00:00.000+0100"},
        "zip_code": "00000",
    }
    rec.update(extra)
    return json.dumps({k: v for k, v in rec.items() if v is not ...})


def write_files(folder, files: dict[str, list]) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, rows in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            for r in rows:
                fh.write((r if isinstance(r, str) else trip_line(*r)) + "\n")
    return str(folder)


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def fixture_dir(tmp_path):
    return write_files(tmp_path / "files", FIXTURE_FILES)


@pytest.fixture()
def fixture_trips(spark, fixture_dir):
    from stationflow.sources import read_trip_files

    return read_trip_files(spark, fixture_dir)


def rows(df, *cols):
    """Rows as plain tuples of the given columns, sorted."""
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
