"""Properties that hold for any trips."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from stationflow import operators as op
from stationflow import plans
from stationflow.schema import TRIPS_SCHEMA
from stationflow.sources import trips_from_lineitem

trip = st.tuples(
    st.sampled_from(["201801_a.json", "201801_b.json", "201802_a.json"]),
    st.integers(0, 200),
    st.integers(0, 5),
    st.integers(0, 5),
    st.integers(1, 3),
)


def _df(spark, rows):
    return spark.createDataFrame([(f, f[:6], t, o, d, u) for f, t, o, d, u in rows], TRIPS_SCHEMA)


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_connections_sum_to_twice_the_trips(spark, rows):
    conn = op.connections(op.trip_ends(_df(spark, rows)))
    per_file = {r[0]: r[1] for r in conn.groupBy("file_name").agg(F.sum("connections")).collect()}
    expected = {}
    for f, *_ in rows:
        expected[f] = expected.get(f, 0) + 2
    assert per_file == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_reversing_trips_swaps_directions(spark, rows):
    trips = _df(spark, rows)
    reversed_trips = trips.select(
        "file_name", "month", "travel_time",
        F.col("destination").alias("origin"), F.col("origin").alias("destination"), "user_type",
    )
    fwd = op.role_means(op.trip_ends(trips))
    rev = op.role_means(op.trip_ends(reversed_trips))
    swapped = rev.select("file", "file_name", "month", "station", "connections",
                         F.col("time_to").alias("time_from"), F.col("time_from").alias("time_to"))
    assert _set(fwd) == _set(swapped)


def test_repartitioning_changes_nothing(spark):
    trips = trips_from_lineitem(spark, SF001)
    shuffled = trips.repartition(13, "origin")
    for report in (
        lambda t: plans.top_times(t, user_type=None, rounded=True),
        lambda t: plans.top_connections(t, user_type=1),
        lambda t: plans.total_connections_report(t, user_type=None, with_time=True),
        lambda t: plans.total_times_report(t, user_type=1),
    ):
        assert _set(report(trips)) == _set(report(shuffled))


nullable_trip = st.tuples(
    st.sampled_from(["201801_a.json", "201802_a.json"]),
    st.one_of(st.integers(0, 50), st.none()),
    st.one_of(st.integers(0, 4), st.none()),
    st.one_of(st.integers(0, 4), st.none()),
    st.integers(1, 2),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(nullable_trip, min_size=1, max_size=40), st.booleans())
def test_list_path_equals_single_pass_with_nulls(spark, rows, rounded):
    ends = op.trip_ends(_df(spark, rows))
    split = op.split_connection_lists(op.connection_lists(ends))
    assert _set(op.list_role_means(split, rounded=rounded)) == _set(
        op.role_means(ends, rounded=rounded)
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 20)), min_size=1, max_size=30))
def test_list_path_rounds_fractional_times_like_single_pass(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("file_name", T.StringType()), T.StructField("month", T.StringType()),
        T.StructField("travel_time", T.DoubleType()), T.StructField("origin", T.LongType()),
        T.StructField("destination", T.LongType()), T.StructField("user_type", T.LongType()),
    ])
    # halves exercise the ties of half-even rounding
    trips = spark.createDataFrame([("f.json", "f.json", h / 2, o, d, 1) for o, d, h in rows], schema)
    ends = op.trip_ends(trips)
    split = op.split_connection_lists(op.connection_lists(ends))
    assert _set(op.list_role_means(split, rounded=True)) == _set(op.role_means(ends, rounded=True))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(nullable_trip, min_size=1, max_size=40), st.lists(nullable_trip, min_size=1, max_size=40))
def test_files_are_independent(spark, first, second):
    """Per-file results do not depend on the other files read with them:
    the table of two batches of files equals the union of their tables."""
    second = [("201803_b.json", *rest) for _, *rest in second]  # distinct files
    together = op.station_stats(op.trip_ends(_df(spark, first + second)))
    apart = op.union_months(
        op.station_stats(op.trip_ends(_df(spark, first))),
        op.station_stats(op.trip_ends(_df(spark, second))),
    )
    assert _set(together) == _set(apart)
