"""``python -m callsift.plans.cli --input DIR --output DIR [--verbose]``."""

from __future__ import annotations

import argparse
import logging
import sys


def setup_logging(verbose: bool) -> None:
    logging.basicConfig(
        level=logging.DEBUG if verbose else logging.INFO, stream=sys.stderr, format="%(asctime)s %(levelname)s %(name)s %(message)s"
    )
    logging.getLogger("py4j").setLevel(logging.WARNING)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Analyse call transcripts.")
    parser.add_argument("--input", required=True, help="folder with one subfolder per transcript")
    parser.add_argument("--output", required=True, help="folder of the runs")
    parser.add_argument("--verbose", action="store_true")
    args = parser.parse_args(argv)
    setup_logging(args.verbose)
    from pyspark.sql import SparkSession

    from callsift.plans.run import run_pipeline
    from callsift.settings import Settings

    spark = SparkSession.builder.appName("callsift").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run = run_pipeline(spark, args.input, args.output, Settings.load())
    logging.getLogger(__name__).info("finished %s", run.directory)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
