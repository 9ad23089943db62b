"""Load the CSV files, build the mart and check it: ``python -m orderloom --source-dir DIR``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans import build


def main(arguments: Sequence[str] | None = None) -> int:
    """0 if all checks pass, 1 if the build was stopped; the verdicts are printed."""
    parser = argparse.ArgumentParser(prog="orderloom", description=__doc__)
    parser.add_argument("--source-dir", help="folder of the CSV files")
    parser.add_argument("--raw-database", default="raw")
    parser.add_argument("--gold-database", default="gold")
    parser.add_argument("--report-only", action="store_true", help="do not stop on failing checks")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("orderloom").getOrCreate()
    try:
        verdicts = build.run(
            spark,
            given.source_dir,
            given.raw_database,
            given.gold_database,
            fail=not given.report_only,
        )
    except build.FailedChecks as stopped:
        print(stopped, file=sys.stderr)
        return 1
    verdicts.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
