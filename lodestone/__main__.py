"""Command line: python -m lodestone --config pipeline.json [--csv F] [--resumes D] [--output F]."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession

from lodestone.errors import ConsolidationError
from lodestone.plans.config import load_config
from lodestone.plans.consolidate import run

DEFAULT_CONFIG = "config/pipeline_config.json"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("lodestone", description="Consolidate person records into golden records.")
    p.add_argument("--config", help=f"pipeline configuration (else $PIPELINE_CONFIG_PATH, else {DEFAULT_CONFIG})")
    p.add_argument("--csv", help="recruiter CSV, instead of the configured one")
    p.add_argument("--resumes", help="résumé folder or file, instead of the configured one")
    p.add_argument("--output", help="output file, instead of the configured one")
    return p


def overrides(args: argparse.Namespace) -> dict[str, dict[str, str]]:
    given = {"input": {"recruiter_csv_path": args.csv, "resume_directory": args.resumes}, "output": {"output_json_path": args.output}}
    return {s: kept for s, values in given.items() if (kept := {k: v for k, v in values.items() if v})}


def main(argv: list[str] | None = None) -> int:
    """0 if the run succeeded, else 1."""
    args = parser().parse_args(argv)
    try:
        config, projection = load_config(args.config or os.environ.get("PIPELINE_CONFIG_PATH") or DEFAULT_CONFIG, overrides(args))
        logging.basicConfig(level=config.logging.level.upper(), format="%(asctime)s %(levelname)s %(name)s %(message)s")
        spark = SparkSession.builder.appName("lodestone").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        done = run(spark, config, projection)
    except (ConsolidationError, ValueError) as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1
    print(f"{done.golden_records} golden records of {done.records} records: {done.output_path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
