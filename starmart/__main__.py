"""Command line: ``spark-submit`` or ``python -m starmart`` with ``bootstrap`` or ``advance``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmart.plans.jobs import MartJob, advance, bootstrap
from starmart.sources.warehouse import Warehouse


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starmart")
    parser.add_argument("--incoming", required=True, help="folder of the raw monthly files")
    parser.add_argument("--landed", required=True, help="landing folder")
    parser.add_argument("--warehouse", required=True, help="warehouse folder")
    commands = parser.add_subparsers(dest="command", required=True)
    first = commands.add_parser("bootstrap", help="reset the mart and load its first period")
    first.add_argument("--airports", required=True, help="CSV file of airports")
    first.add_argument("--airlines", required=True, help="JSON file of airlines")
    first.add_argument("--year", type=int, required=True)
    first.add_argument("--month", type=int, required=True)
    following = commands.add_parser("advance", help="load the period after the latest one")
    for command in (first, following):
        command.add_argument("--force", action="store_true", help="land the raw file again")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("starmart").getOrCreate()
    job = MartJob(spark, args.incoming, args.landed, Warehouse(spark, args.warehouse))
    if args.command == "bootstrap":
        year, month = args.year, args.month
        added = bootstrap(job, args.airports, args.airlines, year, month, args.force)
    else:
        year, month, added = advance(job, args.force)
    print(f"{month}_{year}: {added} new rows")


if __name__ == "__main__":
    main()
