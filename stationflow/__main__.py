"""Command line: run every report of one variant over a folder of trip files.

    python -m stationflow FOLDER [--variant v1|v2|v3] [--format json|parquet]
                                 [--output DIR] [--k-file 10] [--k-total 20]
                                 [--watch [--interval "1 minute"] | --once]
                                 [--print-rows 200] [--shared-dir DIR]

Without ``--output`` the first ``--print-rows`` rows of each report are
printed, per-file rankings ordered by file and rank (Spark says when a report
has more); with it each report is written as Parquet to
``DIR/<report>``. ``--watch`` keeps running: files that appear in FOLDER
are processed as they arrive and the reports in ``--output`` are refreshed
(the per-file table and the stream checkpoint of each variant live under
``--output``); ``--once`` does the same for the files present now, then stops. The session comes from ``spark-submit`` or the
environment; a local one is started only when none is configured. Intermediate
data goes to ``--shared-dir``, else to the session's ``spark.checkpoint.dir``,
and is deleted at the end."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from stationflow.plans.reports import ordered, original_layout
from stationflow.plans.run import run_variant
from stationflow.schema import TOP_PER_FILE, TOP_TOTAL
from stationflow.sources.trips import read_trip_files, trip_file_glob
from stationflow.streaming import read_trip_stream, start_incremental_reports, write_reports


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stationflow", description=__doc__.splitlines()[0])
    ap.add_argument("folder", help="folder holding the trip files")
    ap.add_argument(
        "--variant",
        choices=["v1", "v2", "v3"],
        default="v3",
        help="v1: unrounded, all users; v2: rounded, all users, totals; v3: as v2, annual users (default)",
    )
    ap.add_argument("--format", choices=["json", "parquet"], default="json", help="trip file format")
    ap.add_argument(
        "--glob",
        default=None,
        help="file name pattern ('' reads every file); default: every file for v1, that of the format (*.json, *.parquet) for v2/v3",
    )
    ap.add_argument("--output", help="write each report as Parquet under this folder")
    ap.add_argument("--k-file", type=int, default=TOP_PER_FILE, help="stations per file in the rankings")
    ap.add_argument("--k-total", type=int, default=TOP_TOTAL, help="stations in the totals")
    ap.add_argument(
        "--original-layout", action="store_true", help="column names and order of the original tables"
    )
    ap.add_argument("--watch", action="store_true", help="keep processing new files, refresh --output")
    ap.add_argument("--once", action="store_true", help="as --watch for the files present now, then stop")
    ap.add_argument("--interval", default="1 minute", help="trigger interval of --watch")
    ap.add_argument("--print-rows", type=int, default=200, help="rows printed of each report without --output")
    ap.add_argument("--shared-dir", help="folder shared by all executors for intermediate data")
    args = ap.parse_args(argv)
    if (args.watch or args.once) and not args.output:
        ap.error("--watch and --once need --output")

    spark = SparkSession.builder.appName("stationflow").getOrCreate()
    if args.shared_dir:
        spark.sparkContext.setCheckpointDir(args.shared_dir)
    default = "" if args.variant == "v1" else trip_file_glob(args.format)
    glob = args.glob if args.glob is not None else default
    if args.watch or args.once:
        return _incremental(spark, args, glob or None)
    trips = read_trip_files(spark, args.folder, fmt=args.format, glob=glob or None)
    with run_variant(trips, args.variant, k_file=args.k_file, k_total=args.k_total) as reports:
        for name, df in reports.items():
            if args.original_layout:
                df = original_layout(ordered(df))
            if args.output:
                df.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/{name}")
            else:
                print(f"\n{name}")
                ordered(df).show(args.print_rows, truncate=False)
    return 0


def _incremental(spark: SparkSession, args, glob: str | None) -> int:
    out = args.output.rstrip("/")
    stream = read_trip_stream(spark, args.folder, fmt=args.format, glob=glob)
    # One table and checkpoint per variant: variants keep different trips.
    table = f"{out}/_station_table/{args.variant}"
    options = {
        "variant": args.variant,
        "k_file": args.k_file,
        "k_total": args.k_total,
        "original_headers": args.original_layout,
    }
    query = start_incremental_reports(
        stream,
        table,
        out,
        f"{out}/_checkpoint/{args.variant}",
        **options,
        available_now=args.once,
        processing_time=None if args.once else args.interval,
    )
    if not args.once:
        print(f"watching {args.folder}; reports refreshed under {out} (stop with Ctrl-C)", file=sys.stderr)
    query.awaitTermination()
    write_reports(spark, table, out, **options)  # also when no new file came
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

