"""``python -m ledgerlake RAW LAKE``: a whole run with the default feed."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerlake.plans.run import Layout, run_all, run_succeeded
from ledgerlake.settings import BATCH_SIZE, Feed


def main() -> int:
    parser = argparse.ArgumentParser(prog="ledgerlake", description="CSV files to bronze, store, statistics and report.")
    parser.add_argument("raw", help="folder with the CSV files")
    parser.add_argument("lake", help="folder for all tables")
    # The names of the options; scheduled runs use them.
    parser.add_argument("--batch-size", type=int, default=BATCH_SIZE, help="rows per reported batch")
    parser.add_argument("--no-stats", action="store_true", help="do not publish audit rows and report")
    parser.add_argument("--max-files", type=int, default=None, help="files per micro-batch")
    parser.add_argument("--scale", type=int, default=None, help="decimals of a price, for exact sums")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("ledgerlake").getOrCreate()
    steps = run_all(
        spark, Layout(given.raw, given.lake), Feed(), given.scale, given.batch_size,
        publish=not given.no_stats, max_files=given.max_files,
    )
    steps.show(truncate=False)
    return 0 if run_succeeded(steps).first()["overall_success"] else 1


if __name__ == "__main__":
    sys.exit(main())
