"""Load a warehouse from sales files; for spark-submit.

    spark-submit run_load.py --cash cash.csv --card card.csv --root /shared/warehouse --as-of 2024-01-01

Without files, the loads run again over the staging tables that are already there.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from strataload.plans import loads, validation
from strataload.sources.csv import read_sales_csv
from strataload.sources.schemas import CARD_COLUMNS, CASH_COLUMNS
from strataload.sources.warehouse import Warehouse


def main(arguments: list[str] | None = None) -> dict[str, int | None]:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the warehouse, reachable by every executor")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="load date")
    parser.add_argument("--cash", help="cash sales file or folder")
    parser.add_argument("--card", help="card sales file or folder")
    parser.add_argument("--date-format", help="pattern of the dates in the files, if not ISO")
    options = parser.parse_args(arguments)
    if bool(options.cash) != bool(options.card):
        parser.error("give both files or none")

    spark = SparkSession.builder.appName("strataload").getOrCreate()
    warehouse = Warehouse(spark, options.root)
    if options.cash:
        cash = read_sales_csv(spark, options.cash, CASH_COLUMNS)
        card = read_sales_csv(spark, options.card, CARD_COLUMNS)
        loads.load_staging(warehouse, cash, card, options.date_format)
    affected = loads.load_all(warehouse, options.as_of)
    validation.load_outcomes(warehouse).orderBy("log_id").show(50, truncate=False)
    validation.dimension_counts(warehouse).show(truncate=False)
    return affected


if __name__ == "__main__":
    main()
