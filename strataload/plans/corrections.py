"""Changes made by hand: alter a customer in the staging rows, take back a version in both layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.operators.quality import matching_rows
from strataload.operators.rows import update_where
from strataload.operators.scd2 import revert_version
from strataload.plans.loads import CASH_TABLE, forget_progress
from strataload.plans.specs import CUSTOMERS, DIMENSIONS
from strataload.sources.warehouse import Warehouse


def set_source_segment(warehouse: Warehouse, key: str, segment: str, current: str | None = None) -> None:
    """Give a customer's cash rows another segment, all of them or those with the current one.

    Writes the batches that hold such rows anew. Loads have seen those batches, so the next ones start over.
    """
    condition = F.trim("customer_id") == key
    if current is not None:
        condition &= F.trim("segment") == current
    warehouse.rewrite_batches(CASH_TABLE, condition, lambda rows: update_where(rows, condition, {"segment": F.lit(segment)}))
    forget_progress(warehouse)


def count_source_segment(warehouse: Warehouse, key: str, segment: str) -> int:
    """Cash rows of a customer that carry a segment."""
    condition = (F.trim("customer_id") == key) & (F.trim("segment") == segment)
    return matching_rows(warehouse.read(CASH_TABLE), condition, "row_count").first()[0]


def take_back_version(warehouse: Warehouse, key: str, segment: str, version_id: int) -> None:
    """Delete a customer's versions with a segment, and reopen an earlier version, in both layers.

    Only the folder of the customer's key is read and written.
    """
    dimension = DIMENSIONS[CUSTOMERS.name]
    for table, id_column in ((dimension.table, dimension.id_column), (CUSTOMERS.table, CUSTOMERS.id_column)):
        versions = warehouse.read_key(table, key)
        unwanted, reopened = F.col("customer_segment") == segment, F.col(id_column) == version_id
        changed = revert_version(versions, unwanted, reopened)
        warehouse.merge(table, changed, deleted=versions.where(unwanted))
