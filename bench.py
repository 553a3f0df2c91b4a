"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Every result is
computed in full and thrown away by the no-op sink. One small run first starts the JVM.
"""

from __future__ import annotations

import json
import os
import time

from strataload.operators.rows import number_pairs
from strataload.registry.queries import QUERIES
from strataload.session import local_session, scratch_path

HEADLINE = [
    "stage_cast_dedup",
    "stage_card",
    "ship_modes_delta",
    "returned_delta",
    "payments_delta",
    "locations_delta",
    "employees_delta",
    "products_delta",
    "surrogate_keys",
    "scd2_changes",
    "scd2_apply",
    "scd2_v2_apply",
    "scd2_propagate",
    "dim_upsert_products",
    "dim_upsert_employees",
    "dim_upsert_locations",
    "dim_upsert_customers_scd",
    "dim_time_day",
    "dim_counts",
    "reconcile",
    "source_profile",
    "scd2_rebuild",
    "fact_load",
    "reconcile_buckets",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def write_six_million(spark) -> None:
    """Two inserts of 1,000,000 and 5,000,000 generated rows, and the count after both."""
    path = scratch_path(spark, "pairs")
    for rows in (1_000_000, 5_000_000):
        number_pairs(spark, rows).write.mode("append").parquet(path)
    if spark.read.parquet(path).count() != 6_000_000:
        raise AssertionError("rows are missing")


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cores)
    drain(QUERIES["scd2_apply"](spark, directory))
    timed: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        drain(QUERIES[name](spark, directory))
        timed[name] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    write_six_million(spark)
    timed["insert_six_million"] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
