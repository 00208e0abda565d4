"""Figures measured independently on the sf0.01 test tables (trips derived
from lineitem): counts of trips, ends, self-loops, file x station rows,
one-sided stations, report sizes and the heads of two total rankings."""

from __future__ import annotations

import os

import pytest

from conftest import SF01
from stationflow import operators as op
from stationflow import plans
from stationflow.sources import trips_from_lineitem

pytestmark = pytest.mark.skipif(not os.path.exists(SF01), reason="sf0.01 not present")


@pytest.fixture(scope="module")
def trips(spark):
    return trips_from_lineitem(spark, SF01)


def test_trip_and_end_counts(trips):
    assert trips.count() == 60_000
    assert op.filter_user_type(trips, 1).count() == 8_590
    assert op.trip_ends(trips).count() == 120_000
    assert trips.select("month").distinct().count() == 83
    assert trips.where("origin = destination").count() == 990
    assert trips.where("origin = destination AND user_type = 1").count() == 127


@pytest.mark.parametrize(
    "user_type, rows, departures, arrivals, both",
    [(None, 4_978, 4_145, 4_970, 4_137), (1, 4_701, 3_609, 4_107, 3_015)],
)
def test_station_table_sizes(trips, user_type, rows, departures, arrivals, both):
    stats = op.station_stats(op.trip_ends(op.filter_user_type(trips, user_type)))
    assert stats.count() == rows
    assert stats.where("n_from > 0").count() == departures
    assert stats.where("n_to > 0").count() == arrivals
    assert stats.where("n_from > 0 AND n_to > 0").count() == both


def test_report_sizes_and_heads(trips):
    assert plans.top_times(trips, user_type=None, rounded=True).count() == 830
    assert plans.top_times(trips, user_type=1, rounded=True).count() == 825
    assert plans.top_connections(trips, user_type=1).count() == 830
    q9 = [tuple(r) for r in plans.total_connections_report(trips, user_type=1).collect()]
    assert q9[:3] == [(0, 4), (1, 4), (2, 4)]
    q10 = [tuple(r) for r in plans.total_times_report(trips, user_type=1).collect()]
    assert q10[:3] == [(42, 28, 28), (11, 26, 28), (21, 25, 28)]
