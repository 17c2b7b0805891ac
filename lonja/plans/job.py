"""Command line: seed the calendar, then load the mart from a landing folder.

    python -m lonja.plans.job calendar --database dwh --location L --landing P --start-year 2025
    python -m lonja.plans.job load --database dwh --location L --landing P --format csv
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from lonja.operators.calendar import year_range
from lonja.plans.load import run_load, seed_calendar
from lonja.session import apply_settings
from lonja.sources.mart_tables import MartTables
from lonja.sources.registry import PLACE, landing_sources, read_source
from lonja.sources.schemas import LANDING
from lonja.sources.staging import ROW


def arguments(argv: list[str]) -> argparse.Namespace:
    this_year = datetime.now(UTC).year
    parser = argparse.ArgumentParser(prog="lonja")
    parser.add_argument("step", choices=("calendar", "load"))
    parser.add_argument("--database", required=True)
    parser.add_argument("--location", required=True, help="folder of the mart tables")
    parser.add_argument("--landing", required=True, help="folder of the raw sources")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv", "json", "orc"))
    parser.add_argument("--start-year", type=int, default=this_year - 1)
    parser.add_argument("--end-year", type=int, default=this_year + 1)
    parser.add_argument("--max-rows", type=int)
    parser.add_argument("--mode", default="strict", choices=("strict", "permissive"))
    return parser.parse_args(argv)


def main(argv: list[str]) -> int:
    """0 when the step and its checks passed, 1 otherwise."""
    args = arguments(argv)
    spark = apply_settings(SparkSession.builder.appName("lonja").getOrCreate())
    mart = MartTables(spark, args.database, args.location)
    sources = landing_sources(args.landing, args.format)
    try:
        if args.step == "calendar":
            mart.create()
            holidays = read_source(spark, sources, "festivos", order=ROW)
            years = year_range(spark, args.start_year, args.end_year)
            print(seed_calendar(mart, years, holidays, ROW))
        else:
            raw = {key: read_source(spark, sources, key, order=PLACE) for key in LANDING}
            result = run_load(mart, raw, max_rows=args.max_rows, mode=args.mode)
            result.stages.show(100, truncate=False)
            result.report.show(100, truncate=False)
    except (RuntimeError, ValueError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
