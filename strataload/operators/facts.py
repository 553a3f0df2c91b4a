"""Sales as facts: every member looked up, customers in the version valid on the order date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.functions.text import clean_text, fold_null
from strataload.operators.dedup import union_all
from strataload.operators.keys import DEFAULT_KEY, business_rows
from strataload.operators.matching import join_hot_keys
from strataload.plans.specs import CUSTOMERS, DIMENSIONS

_FOLDED = ("ship_modes", "payments", "returned")
LOCATION = ("country", "city", "state", "postal_code", "region")
MEASURES = ["order_id", "payment_id", "sales", "quantity", "discount", "profit"]


def all_sales(cash: DataFrame, card: DataFrame) -> DataFrame:
    """Both systems under one layout. Cash sales do not say whether they were returned."""
    return union_all([cash.withColumn("returned", F.lit(None).cast("string")).withColumn("_card", F.lit(False)),
                      card.withColumn("_card", F.lit(True))])


def _member_keys() -> dict[str, list[tuple[str, Column]]]:
    """Per dimension: its columns and the expressions over a sale they must equal."""
    keys: dict[str, list[tuple[str, Column]]] = {
        "locations": [(c, clean_text(F.col(c))) for c in LOCATION],
        "employees": [("employee_src_id", F.trim("employee_id"))],
        "products": [("product_src_id", F.trim("product_id"))],
    }
    for name in _FOLDED:
        spec = DIMENSIONS[name].entity
        keys[name] = [(spec.key, F.trim(fold_null(F.col(spec.key_parts[0]))))]
    # Only a card sale has an answer to this.
    keys["returned"] = [(c, F.when(F.col("_card"), value)) for c, value in keys["returned"]]
    return keys


def _lookup(sales: DataFrame, members: DataFrame, id_column: str, pairs: list[tuple[str, Column]], as_name: str) -> DataFrame:
    """``sales`` with the id of the member that meets all pairs, -1 for none."""
    keyed = business_rows(members, id_column).select(
        F.col(id_column).alias("_id"), *[F.col(c).alias(f"_k{i}") for i, (c, _) in enumerate(pairs)]
    )
    condition = [value == F.col(f"_k{i}") for i, (_, value) in enumerate(pairs)]
    joined = sales.join(keyed, condition, "left")
    return joined.select(*sales.columns, F.coalesce("_id", F.lit(DEFAULT_KEY)).cast("long").alias(as_name))


def with_customer_version(sales: DataFrame, customers: DataFrame, as_name: str = "customer_surr_id") -> DataFrame:
    """``sales`` with the version of the customer valid on the order date, -1 if there is none.

    The join is on the customer's key; the dates only choose among the versions of one customer. Customers with a
    large share of the sales are spread over several tasks.
    """
    versions = business_rows(customers, DIMENSIONS[CUSTOMERS.name].id_column).select(
        F.trim(CUSTOMERS.key).alias("_key"), F.col("customer_surr_id").alias("_id"), "start_dt", "end_dt"
    )
    keyed = sales.withColumn("_key", F.trim("customer_id"))
    valid = F.col("order_date").between(F.col("start_dt"), F.col("end_dt"))
    joined = join_hot_keys(keyed, versions, "_key", "payment_id", valid)
    return joined.select(*sales.columns, F.coalesce("_id", F.lit(DEFAULT_KEY)).cast("long").alias(as_name))


def fact_rows(
    cash: DataFrame, card: DataFrame, dimensions: Mapping[str, DataFrame], calendar: DataFrame, as_of: dt.date
) -> DataFrame:
    """One fact per sale. ``dimensions`` is by entity name. The profit ratio is profit over sales, NULL without sales."""
    sales = with_customer_version(all_sales(cash, card), dimensions[CUSTOMERS.name])
    for name, pairs in _member_keys().items():
        id_column = DIMENSIONS[name].id_column
        sales = _lookup(sales, dimensions[name], id_column, pairs, id_column)
    for column in ("order_date", "ship_date"):
        sales = _lookup(sales, calendar, "date_surr_id", [("date", F.col(column))], f"{column}_surr_id")
    ratio = F.when(F.col("sales") != 0, (F.col("profit") / F.col("sales")).cast("decimal(18,4)"))
    return sales.select(
        "customer_surr_id",
        "location_surr_id",
        "product_surr_id",
        "employee_surr_id",
        "order_date_surr_id",
        "ship_date_surr_id",
        "payment_surr_id",
        "ship_mode_surr_id",
        "returned_surr_id",
        *MEASURES,
        ratio.alias("profit_ratio"),
        F.lit(as_of).alias("insert_dt"),
        F.lit(as_of).alias("update_dt"),
        *[c for c in ("load_batch",) if c in sales.columns],
    )
