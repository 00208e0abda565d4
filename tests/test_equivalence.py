"""Different plans for the same measure agree: the literal join and the
single pass, the connection-list path and the conditional aggregates, the
stacked per-batch tables and the grouped plan, the reports on a shared
materialized table and the standalone ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF001
from stationflow import operators as op
from stationflow import plans
from stationflow.sources import trips_from_lineitem


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def _trips(spark):
    return trips_from_lineitem(spark, SF001)


def test_join_form_equals_single_pass(spark):
    trips = _trips(spark)
    for rounded in (False, True):
        assert _set(op.station_times_join(trips, rounded=rounded)) == _set(
            op.station_times(op.trip_ends(trips), rounded=rounded)
        )


def test_list_path_equals_conditional_aggregates(spark):
    ends = op.trip_ends(_trips(spark))
    split = op.split_connection_lists(op.connection_lists(ends))
    for rounded in (False, True):
        assert _set(op.list_role_means(split, rounded=rounded)) == _set(
            op.role_means(ends, rounded=rounded)
        )


def test_connection_lists_are_lossless(spark):
    ends = op.trip_ends(_trips(spark))
    lists = op.connection_lists(ends)
    assert lists.agg(F.sum("n")).first()[0] == ends.count()
    lengths = lists.groupBy("file", "file_name", "month", "station").agg(F.sum("n").alias("connections"))
    assert _set(lengths) == _set(op.connections(ends))
    split = op.split_connection_lists(lists)
    halves = {r["side"]: r["n"] for r in split.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    assert halves == {"leaving": _trips(spark).count(), "reaching": _trips(spark).count()}


def test_union_months_keeps_trips_without_month(spark):
    from stationflow.plans.catalog import _union_months

    trips = spark.createDataFrame(
        [("a", None, 5, 1, 2, 1), ("a", None, 7, 2, 1, 1)],
        "file_name string, month string, travel_time long, origin long, destination long, user_type long",
    )
    early = F.coalesce(F.col("month") < "199807", F.lit(False))
    stacked = op.union_months(*[op.station_times(op.trip_ends(t), rounded=True) for t in (trips.where(early), trips.where(~early))])
    assert _set(stacked) == _set(op.station_times(op.trip_ends(trips), rounded=True)) and stacked.count() == 2
    assert callable(_union_months)


def test_union_months_equals_grouped_plan(spark):
    trips = op.filter_user_type(_trips(spark), 1)
    first = trips.where(F.col("month") < "199807")
    second = trips.where(F.col("month") >= "199807")
    stacked = op.union_months(
        op.station_times(op.trip_ends(first), rounded=True),
        op.station_times(op.trip_ends(second), rounded=True),
    )
    assert _set(stacked) == _set(op.station_times(op.trip_ends(trips), rounded=True))


def test_run_variant_matches_standalone_reports(spark):
    trips = _trips(spark)
    v3 = plans.run_variant(trips, "v3")
    assert _set(v3["top_connections"]) == _set(plans.top_connections(trips, user_type=1))
    assert _set(v3["top_times"]) == _set(plans.top_times(trips, user_type=1, rounded=True))
    assert _set(v3["total_connections"]) == _set(plans.total_connections_report(trips, user_type=1))
    assert _set(v3["total_times"]) == _set(plans.total_times_report(trips, user_type=1))
    v2 = plans.run_variant(trips, "v2", materialize=False)
    assert _set(v2["total_connections"]) == _set(
        plans.total_connections_report(trips, user_type=None, with_time=True)
    )
    v1 = plans.run_variant(trips, "v1")
    assert set(v1) == {"top_times", "top_connections"}
    assert _set(v1["top_connections"]) == _set(
        plans.top_connections_time(trips, user_type=None, rounded=False)
    )
