"""The load log, and the wrapper that turns a step's outcome into a log row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from threading import Lock
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataload.operators.keys import literal_rows, single_row
from strataload.sources.schemas import LOAD_LOG_SCHEMA, LOAD_MARK_SCHEMA
from strataload.sources.warehouse import Warehouse

LOG_TABLE, MARK_TABLE = "bl_cl.load_log", "bl_cl.load_marks"
SUCCESS, ERROR = "SUCCESS", "ERROR"
_INTERNAL_ERROR = "XX000"
# Loads may run side by side; their log entries are written one after the other.
_log_lock = Lock()


def write_log(
    warehouse: Warehouse,
    procedure_name: str,
    target_table: str | None,
    rows_affected: int | None,
    status: str,
    message: str | None,
    error_code: str | None = None,
    error_message: str | None = None,
) -> None:
    """Append one entry; its number and time are assigned here."""
    values: dict[str, Any] = {
        "procedure_name": procedure_name,
        "target_table": target_table,
        "rows_affected": rows_affected,
        "status": status,
        "message": message,
        "error_code": error_code,
        "error_message": error_message,
    }
    row = single_row(warehouse.spark, LOAD_LOG_SCHEMA, values)
    with _log_lock:
        last = warehouse.read_or_empty(LOG_TABLE).agg(F.coalesce(F.max("log_id"), F.lit(0)).alias("last")).scalar()
        warehouse.append(LOG_TABLE, row.withColumns({"log_id": last + 1, "log_datetime": F.localtimestamp()}))


def last_mark(warehouse: Warehouse, table: str) -> int:
    """The staging batch up to which a table has been loaded; 0 before its first load."""
    marks = warehouse.read_or_empty(MARK_TABLE).where(F.col("target_table") == table)
    newest = marks.orderBy(F.desc("mark_id")).select("batch").first()
    return newest["batch"] if newest else 0


def write_marks(warehouse: Warehouse, tables: Sequence[str], batch: int) -> None:
    """Note that tables hold everything up to a staging batch."""
    with _log_lock:
        last = warehouse.read_or_empty(MARK_TABLE).agg(F.coalesce(F.max("mark_id"), F.lit(0)).alias("last")).first()
        rows = [(last["last"] + i, table, batch) for i, table in enumerate(tables, 1)]
        warehouse.append(MARK_TABLE, literal_rows(warehouse.spark, rows, LOAD_MARK_SCHEMA))


def error_code(error: Exception) -> str:
    """The five-character SQL state an error carries, if any."""
    state = getattr(error, "sqlstate", None)
    if state is None and isinstance(error, PySparkException):
        state = error.getSqlState()
    return state or _INTERNAL_ERROR


def run_step(
    warehouse: Warehouse, table: str, step: Callable[[], int], raise_on_error: bool = False
) -> int | None:
    """Run one load and log it. The step returns the number of rows it affected.

    A step writes its table once, as its last act, so a failed step leaves the table as it was. The failure
    is logged with 0 rows and goes no further unless ``raise_on_error`` is set.
    """
    name = table.split(".")[-1]
    procedure = f"prc_load_{name}"
    try:
        affected = step()
    except Exception as error:
        write_log(
            warehouse, procedure, table, 0, ERROR, f"Error while loading {name.upper()}.", error_code(error), str(error)
        )
        if raise_on_error:
            raise
        return None
    write_log(warehouse, procedure, table, affected, SUCCESS, f"{name.upper()} loaded successfully.")
    return affected
