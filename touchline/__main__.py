"""Job entry: ``spark-submit -m touchline`` / ``python -m touchline``.

    python -m touchline INPUT [INPUT ...] --output-dir OUT
        [--session-timeout SECONDS] [--sort-by-time] [--no-validate-schema]
        [--metadata] [--run-date YYYY-MM-DD]

Reads the hit files, runs the attribution once (scan + visitor window,
checkpointed in ``spark.checkpoint.dir``), writes the dated report and,
with ``--metadata``, the run manifest.  Exit code 1 on input or output errors.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time

from pyspark.sql import SparkSession

from .errors import AttributionError
from .options import AttributionOptions


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="touchline", description="Search keyword revenue attribution")
    p.add_argument("inputs", nargs="+", help="hit files, folders or globs (.tsv, .gz, .zst)")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--session-timeout", type=int, default=None)
    p.add_argument("--sort-by-time", action="store_true", help="process in (hit time, arrival) order")
    p.add_argument("--no-validate-schema", action="store_true")
    p.add_argument("--metadata", action="store_true", help="also write the run manifest")
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=None)
    p.add_argument("--visitor-partitions", type=int, default=None)
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    try:
        options = AttributionOptions(
            session_timeout=args.session_timeout,
            order="time" if args.sort_by_time else "file",
            validate_schema=not args.no_validate_schema,
            visitor_partitions=args.visitor_partitions,
        )
    except ValueError as e:
        print(f"touchline: {e}", file=sys.stderr)
        return 2
    from .plans.attribution import attribute_files
    from .plans.sinks import manifest, write_manifest, write_report

    spark = SparkSession.builder.appName("touchline").getOrCreate()
    started = time.monotonic()
    try:
        run = attribute_files(spark, args.inputs, options).materialize()
        report = write_report(run, args.output_dir, args.run_date)
        print(report)
        if args.metadata:
            doc = manifest(run, ",".join(args.inputs), started, results_path=report)
            print(write_manifest(spark, doc, args.output_dir, args.run_date, run))
    except AttributionError as e:
        print(f"touchline: {type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
