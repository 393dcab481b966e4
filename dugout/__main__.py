"""Command line: ``python -m dugout run|direct --documents ... --tables ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from .plans import season
from .session import build_session, clear_scratch


def main() -> None:
    parser = argparse.ArgumentParser(prog="dugout", description=__doc__)
    parser.add_argument("job", choices=["run", "direct"])
    for folder in ("documents", "messages", "tables", "checkpoints"):
        parser.add_argument(f"--{folder}", required=True)
    parser.add_argument("--season", type=int, required=True)
    parser.add_argument("--day", type=date.fromisoformat, required=True)
    parser.add_argument("--first-day", type=date.fromisoformat, help="first day of the season's games")
    parser.add_argument("--as-of", type=datetime.fromisoformat, required=True)
    parser.add_argument("--run-id", required=True, help="must sort after all earlier ones")
    parser.add_argument("--whole-files", action="store_true", help="one document per file")
    parser.add_argument("--lenient", action="store_true", help="report failed checks, do not raise")
    options = parser.parse_args()

    spark = build_session("dugout")
    try:
        start(spark, options)
    finally:
        clear_scratch(spark)


def start(spark: SparkSession, options: argparse.Namespace) -> None:
    paths = season.Paths(options.documents, options.messages, options.tables, options.checkpoints)
    if options.job == "direct":
        season.run_direct(
            spark, paths, options.season, options.day, options.run_id, options.whole_files
        ).show(truncate=False)
        return
    tables = season.run(
        spark, paths, options.season, options.day, options.as_of, options.run_id,
        not options.lenient, options.whole_files, options.first_day,
    )
    for report in ("published", "landed", "contracts", "freshness", "volume"):
        tables[report].show(100, truncate=False)


if __name__ == "__main__":
    main()
