"""Insert-or-update by primary key that touches changed rows only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.functions.compare import any_distinct
from strataload.functions.dates import HIGH_DATE, calendar_columns
from strataload.functions.text import clean_flag, clean_text
from strataload.operators.dedup import union_distinct
from strataload.operators.keys import business_rows
from strataload.plans.specs import DimensionSpec

INSERT, UPDATE, KEEP = "insert", "update", "keep"
ACTION = "merge_action"


def detect_upserts(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compared: Sequence[str],
    on_update: Mapping[str, Column | None] | None = None,
) -> DataFrame:
    """Rows to write, with their action: source rows that are absent from or differ from the target.

    ``on_update`` lists columns an update does not take from the source: a value sets them, None
    keeps what is stored.
    """
    on_update = on_update or {}
    kept = [c for c, value in on_update.items() if value is None]
    stored = target.select(
        F.col(key).alias("_stored_key"), *[F.col(c).alias(f"_{c}") for c in dict.fromkeys([*compared, *kept])]
    )
    joined = source.join(stored, source[key] == stored["_stored_key"], "left")
    absent = F.col("_stored_key").isNull()
    differs = any_distinct([(F.col(c), F.col(f"_{c}")) for c in compared])
    values = []
    for column in source.columns:
        if column in on_update:
            fixed = on_update[column]
            replacement = F.col(f"_{column}") if fixed is None else fixed
            values.append(F.when(absent, F.col(column)).otherwise(replacement).alias(column))
        else:
            values.append(F.col(column))
    action = F.when(absent, F.lit(INSERT)).otherwise(F.lit(UPDATE)).alias(ACTION)
    return joined.where(absent | differs).select(*values, action)


def apply_upserts(target: DataFrame, upserts: DataFrame, key: str) -> DataFrame:
    """State after the upserts, with the action taken on each row.

    ``upserts`` is read twice, so pass written rows. They are few on a rerun, and then Spark
    broadcasts them by their actual size and the target is not shuffled.
    """
    keys = upserts.select(F.col(key).alias("_upserted"))
    untouched = target.join(keys, target[key] == keys["_upserted"], "left_anti")
    return untouched.withColumn(ACTION, F.lit(KEEP)).unionByName(upserts)


def dimension_rows(spec: DimensionSpec, entity: DataFrame, as_of: dt.date) -> DataFrame:
    """Entity rows in the layout of the dimension, cleansed, without the unknown member."""
    today = F.lit(as_of)
    columns = [F.col(spec.entity.id_column).cast("long").alias(spec.id_column), F.trim(spec.entity.key).alias(spec.entity.key)]
    columns += [
        clean_text(F.col(c)).alias(c) for c in [*spec.entity.attribute_names, "source_system", "source_entity"]
    ]
    if spec.entity.versioned:
        columns += [
            F.coalesce("start_dt", today).alias("start_dt"),
            F.coalesce("end_dt", F.lit(HIGH_DATE)).alias("end_dt"),
            clean_flag(F.col("is_active")).alias("is_active"),
            F.coalesce("insert_dt", today).alias("insert_dt"),
        ]
    else:
        columns += [F.coalesce(c, today).alias(c) for c in ("insert_dt", "update_dt")]
    return business_rows(entity, spec.entity.id_column).select(*columns)


def dimension_upserts(spec: DimensionSpec, entity: DataFrame, target: DataFrame, as_of: dt.date) -> DataFrame:
    """Upserts for one dimension.

    A versioned dimension mirrors its entity: every column is compared and overwritten. The others
    keep the date of their first load and stamp the date of the update.
    """
    source = dimension_rows(spec, entity, as_of)
    if spec.entity.versioned:
        compared = [c for c in source.columns if c != spec.id_column]
        return detect_upserts(target, source, spec.id_column, compared)
    stamps = {"insert_dt": None, "update_dt": F.lit(as_of)}
    return detect_upserts(target, source, spec.id_column, spec.compared, stamps)


def observed_days(cash: DataFrame, card: DataFrame) -> DataFrame:
    """Every order or ship date of either source, once. Each source is read once."""

    def days(frame: DataFrame) -> DataFrame:
        return frame.select(F.explode(F.array("order_date", "ship_date")).alias("date")).where("date is not null")

    return union_distinct([days(cash), days(card)])


def calendar_rows(cash: DataFrame, card: DataFrame) -> DataFrame:
    return observed_days(cash, card).select(*calendar_columns(F.col("date")))


def calendar_upserts(cash: DataFrame, card: DataFrame, target: DataFrame) -> DataFrame:
    source = calendar_rows(cash, card)
    return detect_upserts(target, source, "date_surr_id", [c for c in source.columns if c != "date_surr_id"])
