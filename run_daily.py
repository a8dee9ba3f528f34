"""Command line of the daily run, for spark-submit.

    spark-submit --packages <your database driver> --py-files tillmart.zip run_daily.py \
        --source gs://bucket/sales --output gs://bucket/marts --ledger gs://bucket/ledger \
        --jdbc-url jdbc:mysql://host:3306/shop --jdbc-properties db.json

``db.json`` holds the JDBC properties: user, password, driver. Keep it out of the repository.
"""

import argparse
import dataclasses
import json
import logging
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tillmart.plans.daily import DailyConfig, run


def arguments():
    parser = argparse.ArgumentParser(description="Load new sales drops and write the sales marts.")
    parser.add_argument("--source", required=True, help="folder with the CSV drops")
    parser.add_argument("--output", required=True, help="folder for the Parquet marts")
    parser.add_argument("--ledger", required=True, help="folder of the file ledger")
    parser.add_argument("--jdbc-url", required=True)
    parser.add_argument("--jdbc-properties", help="JSON file with the JDBC properties")
    parser.add_argument("--customer-partition-column", default="customer_id", help="numeric key to read customers in parallel by")
    parser.add_argument("--store-partition-column", default="id", help="the same for stores")
    parser.add_argument("--sales-team-partition-column", default="id", help="the same for sales staff")
    parser.add_argument("--read-partitions", type=int, default=16, help="connections per table read")
    parser.add_argument("--fetch-size", type=int, default=10_000, help="rows a connection holds at a time")
    parser.add_argument("--by-scan", action="store_true", help="read headers through Spark, for storage that only Spark reaches")
    parser.add_argument("--months", metavar="NAME", help="folder below the output for months computed anew from all batches")
    parser.add_argument("--resume", action="store_true", help="go on although an earlier run did not finish")
    return parser.parse_args()


def main():
    args = arguments()
    logging.basicConfig(level=logging.INFO)
    properties = {}
    if args.jdbc_properties:
        with open(args.jdbc_properties) as file:
            properties = json.load(file)
    config = DailyConfig(
        source_dir=args.source, output_dir=args.output, ledger_dir=args.ledger,
        jdbc_url=args.jdbc_url, jdbc_properties=properties,
        customer_partition_column=args.customer_partition_column,
        store_partition_column=args.store_partition_column, sales_team_partition_column=args.sales_team_partition_column,
        read_partitions=args.read_partitions, fetch_size=args.fetch_size, by_scan=args.by_scan, months_dir=args.months, resume=args.resume,
    )
    spark = SparkSession.builder.appName("sales-marts").getOrCreate()
    report = run(spark, config, datetime.now(timezone.utc))
    logging.info("finished: %s", json.dumps(dataclasses.asdict(report)))
    spark.stop()


if __name__ == "__main__":
    main()
