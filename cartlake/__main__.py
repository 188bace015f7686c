"""Run the layers, one or all.

    python -m cartlake all RAW_FOLDER
    python -m cartlake silver --tables tables.yaml --quality quality.yaml
    python -m cartlake gold --input orders=shop_orders --input customers=shop_customers
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from cartlake.plans import medallion
from cartlake.plans.views import publish_views
from cartlake.sources.csv import verify_raw_files
from cartlake.specs import RETAIL_TABLES, expected_lines, load_specs, load_thresholds


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cartlake")
    parser.add_argument("step", choices=("verify", "bronze", "silver", "gold", "views", "all"))
    parser.add_argument("raw", nargs="?", help="folder of the raw files, for verify, bronze and all")
    parser.add_argument("--tables", help="file of table specs; the nine retail tables if left out")
    parser.add_argument("--quality", help="file of quality limits; no quality gate if left out")
    parser.add_argument(
        "--input", action="append", default=[], metavar="NAME=TABLE", help="silver table of a gold input"
    )
    parser.add_argument(
        "--first", type=dt.date.fromisoformat, help="first day of dim_dates; as far as the orders go if left out"
    )
    parser.add_argument("--last", type=dt.date.fromisoformat, help="last day of dim_dates")
    parser.add_argument("--skip-loaded", action="store_true", help="leave out raw files loaded before")
    parser.add_argument(
        "--mode",
        choices=("overwrite", "partitions", "incremental"),
        default="overwrite",
        help="what silver and gold replace; incremental loads new raw files only",
    )
    parser.add_argument("--workers", type=int, default=4, help="tables loaded side by side")
    a = parser.parse_args(argv)
    if a.raw is None and a.step in ("verify", "bronze", "all"):
        parser.error(f"{a.step} needs the folder of the raw files")
    logging.basicConfig(level=logging.INFO)
    specs = load_specs(a.tables) if a.tables else RETAIL_TABLES
    limits = load_thresholds(a.quality) if a.quality else None
    names = dict(pair.split("=", 1) for pair in a.input)
    spark = SparkSession.builder.appName("cartlake").getOrCreate()
    if a.step == "verify":
        verify_raw_files(spark, a.raw, expected_lines(specs)).show(truncate=False)
    if a.step in ("bronze", "all"):
        new = a.mode == "incremental"
        medallion.run_bronze(spark, a.raw, specs, skip_loaded=a.skip_loaded or new, workers=a.workers, by_load=new)
    if a.step in ("silver", "all"):
        medallion.run_silver(spark, specs, limits=limits, workers=a.workers, mode=a.mode)
    if a.step in ("gold", "all"):
        medallion.run_gold(spark, names=names, first=a.first, last=a.last, workers=a.workers, mode=a.mode)
    if a.step in ("views", "all"):
        publish_views(spark)


if __name__ == "__main__":
    main()
