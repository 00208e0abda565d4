"""Plan shape: one scan with pruned columns and pushed filter, partial
aggregation, no Python evaluation, bounded top-k operators."""

from __future__ import annotations

from conftest import SF001
from stationflow import plans
from stationflow.sources import trips_from_lineitem


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = plans.top_connections(trips_from_lineitem(spark, SF001), user_type=1)
    p = _plan(df)
    assert p.count("FileScan parquet") == 1
    assert "PushedFilters: [IsNotNull(l_linenumber), EqualTo(l_linenumber,1)]" in p
    # only the columns the report needs are read
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in p
    assert "partial_count" in p
    assert "WindowGroupLimit" in p
    assert "Python" not in p and "ArrowEval" not in p


def test_totals_plan_is_top_k_not_full_sort(spark):
    df = plans.total_times_report(trips_from_lineitem(spark, SF001), user_type=None)
    p = _plan(df)
    assert p.count("FileScan parquet") == 1
    assert "TakeOrderedAndProject" in p
    assert "partial_avg" in p
    assert "BroadcastExchange" not in p or "AdaptiveSparkPlan" in p


def test_single_pass_has_no_join(spark):
    from stationflow import operators as op

    trips = trips_from_lineitem(spark, SF001)
    p = _plan(op.station_times(op.trip_ends(trips), rounded=True))
    assert "Join" not in p and p.count("FileScan parquet") == 1
    # only the aggregates the time table uses are computed
    assert "bround(travel_time" not in p


def test_json_scan_reads_four_fields(spark, fixture_dir):
    from stationflow.sources import read_trip_files

    df = plans.top_connections(read_trip_files(spark, fixture_dir), user_type=1)
    p = _plan(df)
    assert p.count("FileScan json") == 1
    # user_type is read for the filter; the seven unused record fields are not
    assert "ReadSchema: struct<idunplug_station:bigint,idplug_station:bigint,user_type:bigint>" in p
    assert "Python" not in p
    # the file key, made once per trip, takes no regular expression
    assert "regexp_extract" not in p


def test_variant_run_reports_do_not_rescan_trips(spark):
    trips = trips_from_lineitem(spark, SF001)
    for name, df in plans.run_variant(trips, "v3").items():
        p = _plan(df)
        assert "l_suppkey" not in p, name


def test_split_lists_scan_once(spark):
    import __spark_entry__ as entry

    for key in ("list_role_means", "list_role_means_rounded"):
        p = _plan(entry.queries()[key](spark, SF001))
        assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning") == 2, key


def test_reports_use_fixed_width_hash_aggregation(spark):
    """Every aggregation buffer is fixed-width (counts, sums, means): no
    report falls back to sort-based or object hash aggregation."""
    import __spark_entry__ as entry

    for key in ("top_times_raw", "top_connections_time_raw", "top_times_rounded",
                "top_connections_time_rounded", "total_connections_all", "total_times_all",
                "top_times_annual", "top_connections_annual", "total_connections_annual",
                "total_times_annual"):
        p = _plan(entry.queries()[key](spark, SF001))
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p, key
        assert "HashAggregate" in p, key


def test_shuffle_count(spark):
    """One shuffle per aggregation level and one for the per-file ranking;
    nothing else moves data."""
    import __spark_entry__ as entry

    expected = {
        "connections_annual": 1,
        "station_times_rounded": 1,
        "role_means_rounded": 1,
        "top_connections_annual": 2,
        "top_times_rounded": 2,
        "top_connections_time_rounded": 2,
        "total_connections_all": 2,
        "total_times_annual": 2,
    }
    for key, n in expected.items():
        p = _plan(entry.queries()[key](spark, SF001))
        assert p.count("Exchange hashpartitioning") == n, (key, p)
        assert "Exchange rangepartitioning" not in p and "Exchange SinglePartition" not in p, key


def test_month_filter_prunes_files(spark, tmp_path):
    """A filter on the month label becomes a predicate on the file name,
    which Spark applies when listing files: other months are never read."""
    from pyspark.sql import functions as F

    from conftest import FIXTURE_FILES, write_files
    from stationflow.sources import read_trip_files

    folder = write_files(tmp_path / "months", FIXTURE_FILES)
    df = read_trip_files(spark, folder).where(F.col("month") == "201801")
    assert df.count() == 7
    df = read_trip_files(spark, folder).where(F.col("month") == "201801")
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def _shuffle_records(df) -> list[int]:
    """Records written by each shuffle of an executed query, root first."""
    out: list[int] = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_shuffle_carries_groups_not_trips(spark):
    """Partial aggregation: the first shuffle moves at most one row per
    (scan task, file, station), never one per trip end."""
    from stationflow import operators as op

    trips = trips_from_lineitem(spark, SF001)
    ends = 2 * trips.count()
    groups = op.station_stats(op.trip_ends(trips)).count()
    tasks = trips.rdd.getNumPartitions()
    df = plans.top_times(trips, user_type=None, rounded=True)
    df.collect()
    first, *later = reversed(_shuffle_records(df))
    assert groups <= first <= groups * tasks < ends
    # the ranking shuffle: at most k rows per file from each partition of
    # the aggregated table, and never more than the aggregated rows
    files = trips.select("file_name").distinct().count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert later and later[0] <= min(first, 10 * files * partitions)
