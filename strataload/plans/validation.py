"""Questions asked of a loaded warehouse. Each answer is a frame; an empty one or zeros mean no finding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.operators import quality, scd2
from strataload.operators.dedup import union_all
from strataload.operators.keys import business_rows
from strataload.plans.load_log import LOG_TABLE
from strataload.plans.loads import dimension_ids
from strataload.plans.specs import CUSTOMERS, DIMENSIONS, ENTITIES
from strataload.sources.warehouse import Warehouse

_CUSTOMER_DIMENSION = DIMENSIONS[CUSTOMERS.name]
_COMPARED = [
    "customer_src_id", "customer_name", "customer_segment", "source_system", "source_entity",
    "start_dt", "end_dt", "is_active", "insert_dt",
]


def _short(table: str) -> str:
    return table.split(".")[-1]


def entity_counts(warehouse: Warehouse) -> DataFrame:
    """Rows per entity."""
    tables = {_short(spec.table): warehouse.read(spec.table) for spec in ENTITIES.values()}
    return quality.table_counts(tables).orderBy("table_name")


def dimension_counts(warehouse: Warehouse) -> DataFrame:
    """Total, unknown-member and business rows per dimension."""
    tables = {_short(t): (warehouse.read(t), i) for t, i in dimension_ids().items()}
    return quality.member_counts(tables).orderBy("table_name")


def duplicate_keys(warehouse: Warehouse) -> DataFrame:
    """Product, active customer and location keys that occur more than once."""
    found = []
    for name in ("products", CUSTOMERS.name, "locations"):
        spec = ENTITIES[name]
        rows = business_rows(warehouse.read(spec.table), spec.id_column)
        if spec.versioned:
            rows = rows.where(F.col("is_active") == "Y")
        duplicates = quality.duplicate_keys(rows, spec.key)
        found.append(
            duplicates.select(F.lit(spec.key).alias("key_name"), F.col(spec.key).alias("key_value"), "row_count")
        )
    return union_all(found)


def active_versions(warehouse: Warehouse) -> DataFrame:
    """Customers with more than one active version, per layer."""
    layers = (
        ("BL_3NF", CUSTOMERS.table, CUSTOMERS.id_column),
        ("BL_DM", _CUSTOMER_DIMENSION.table, _CUSTOMER_DIMENSION.id_column),
    )
    found = [
        quality.not_exactly_one_active(warehouse.read(table), id_column).withColumn("layer_name", F.lit(layer))
        for layer, table, id_column in layers
    ]
    return union_all(found)


def reconcile_customers(warehouse: Warehouse) -> DataFrame:
    """How many customer versions only one of the two layers holds."""
    entity = warehouse.read(CUSTOMERS.table).select(CUSTOMERS.id_column, *_COMPARED)
    dimension = warehouse.read(_CUSTOMER_DIMENSION.table).select(_CUSTOMER_DIMENSION.id_column, *_COMPARED)
    return quality.reconcile(entity, dimension, "only_in_bl_3nf", "only_in_bl_dm")


def customer_history(warehouse: Warehouse, condition: Column | None = None) -> DataFrame:
    """Versions of both layers, of all customers or of those that meet a condition."""
    history = scd2.layer_history(warehouse.read(CUSTOMERS.table), warehouse.read(_CUSTOMER_DIMENSION.table))
    return history if condition is None else history.where(condition)


def load_outcomes(warehouse: Warehouse, tables: list[str] | None = None) -> DataFrame:
    """The latest log entry of each load, of the named tables or of all."""
    log = warehouse.read(LOG_TABLE)
    if tables is not None:
        log = log.where(F.col("procedure_name").isin([f"prc_load_{_short(t)}" for t in tables]))
    return quality.latest_entries(log)
