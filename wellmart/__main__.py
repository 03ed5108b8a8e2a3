"""Command line: run the jobs on a cluster session (spark-submit friendly).

    spark-submit --py-files wellmart.zip wellmart/__main__.py \\
        --raw <raw base> --live <published base> --stage <output base> \\
        [--jobs frac_detail,piping,well_test,header_mart] [--details <published details base>] [--format parquet]

or ``python -m wellmart ...`` where a session can be created locally.

The session comes from the cluster (``getOrCreate``); lineage cuts go to its
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from wellmart.plans.batch import JOBS, run
from wellmart.sources.tables import Catalog


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="wellmart")
    p.add_argument("--raw", required=True, help="base path of the raw tables")
    p.add_argument("--live", required=True, help="base path of the published header")
    p.add_argument("--stage", required=True, help="base path of the outputs")
    p.add_argument("--jobs", default=",".join(JOBS), help="comma-separated subset of " + ",".join(JOBS))
    p.add_argument("--details", help="base path of the published vEsp... tables the mart reads (default: this run's)")
    p.add_argument("--format", default="parquet")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("wellmart").getOrCreate()
    paths = run(spark, Catalog(raw=args.raw, live=args.live, stage=args.stage, fmt=args.format, details=args.details),
                [j for j in args.jobs.split(",") if j])
    for name, path in paths.items():
        logging.getLogger("wellmart").info("%s -> %s", name, path)


if __name__ == "__main__":
    main()
