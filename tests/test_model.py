"""Every report of every variant equals a brute-force model on random
trips: self-loops, one-sided stations, NULL stations and times, two files
with one month label, and many ties at the cut."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from stationflow.plans import run_variant
from stationflow.schema import TRIPS_SCHEMA

FILES = ["201801_usage.json", "201802_usage.json", "201802_extra.json", "201803_usage.json"]
station = st.one_of(st.integers(0, 5), st.none())
trip = st.tuples(
    st.sampled_from(FILES),
    st.one_of(st.integers(0, 30), st.none()),
    station,
    station,
    st.sampled_from([1, 1, 2]),
)


def _spark_reports(spark, trips, variant, k_file, k_total, materialize=False):
    df = spark.createDataFrame([(f, f[:6], t, o, d, u) for f, t, o, d, u in trips], TRIPS_SCHEMA)
    out = {}
    reports = run_variant(df, variant, k_file=k_file, k_total=k_total, materialize=materialize)
    for name, rep in reports.items():
        out[name] = sorted((tuple(r) for r in rep.drop("file").collect()), key=repr)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    trips=st.lists(trip, min_size=1, max_size=60),
    variant=st.sampled_from(["v1", "v2", "v3"]),
    k_file=st.integers(1, 4),
    k_total=st.integers(1, 5),
    materialize=st.booleans(),
)
def test_reports_equal_brute_force(spark, trips, variant, k_file, k_total, materialize):
    got = _spark_reports(spark, trips, variant, k_file, k_total, materialize)
    want = {k: sorted(v, key=repr) for k, v in model.reports(trips, variant, k_file, k_total).items()}
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == want[name], (variant, name)


def test_model_on_hand_fixture():
    from conftest import FIXTURE_FILES

    trips = [(f, t, o, d, u) for f, rows in FIXTURE_FILES.items() for t, o, d, u in rows]
    rep = model.reports(trips, "v2", 10, 20)
    assert rep["total_connections"] == [(1, 4, 20), (2, 3, 19), (3, 1, None), (4, 1, None)]
    assert rep["total_times"] == [(1, 20, 19), (2, 17, 20)]
