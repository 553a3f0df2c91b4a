"""Table layouts, layer by layer. Names and types are the contract with the source systems."""

from __future__ import annotations

from pyspark.sql import types as T

# The source database's DECIMAL has no bound; 18 digits still fit a long, and 4 decimals hold all
# money columns of the sales files.
MONEY = T.DecimalType(18, 4)

TEXT, LONG, INT, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()


def columns(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


def short_text(name: str, limit: int, nullable: bool = True) -> T.StructField:
    return T.StructField(name, TEXT, nullable, {"max_length": limit})


_SALES_HEAD = (
    "payment_id order_id order_date ship_date ship_mode customer_id customer_name segment country city "
    "state postal_code region product_id category sub_category product_name sales quantity discount profit"
)
_SALES_TAIL = "employee_name employee_id payment_type"

CASH_COLUMNS = f"{_SALES_HEAD} {_SALES_TAIL}".split()
CARD_COLUMNS = f"{_SALES_HEAD} returned {_SALES_TAIL}".split()

STAGING_TYPES: dict[str, T.DataType] = {
    "order_date": DATE,
    "ship_date": DATE,
    "sales": MONEY,
    "quantity": INT,
    "discount": MONEY,
    "profit": MONEY,
}


def raw_schema(names: list[str]) -> T.StructType:
    """Every column text, as delivered."""
    return T.StructType([T.StructField(name, TEXT) for name in names])


def staging_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, STAGING_TYPES.get(name, TEXT)) for name in names])


def _versioned(id_column: str, text: str, with_source_id: bool) -> T.StructType:
    lineage = "source_system source_entity" + (" source_id" if with_source_id else "")
    return T.StructType(
        columns(LONG, id_column)
        + columns(TEXT, f"{text} {lineage}")
        + columns(DATE, "start_dt end_dt")
        + [short_text("is_active", 1)]
        + columns(DATE, "insert_dt")
    )


def _overwritten(id_column: str, text: str, with_source_id: bool) -> T.StructType:
    lineage = "source_system source_entity" + (" source_id" if with_source_id else "")
    return T.StructType(
        columns(LONG, id_column) + columns(TEXT, f"{text} {lineage}") + columns(DATE, "insert_dt update_dt")
    )


_LOCATION = "location_src_id country city state postal_code region"
_PRODUCT = "product_src_id product_name category sub_category"

ENTITY_SCHEMAS = {
    "bl_3nf.ce_customers_scd": _versioned("customer_id", "customer_src_id customer_name customer_segment", True),
    "bl_3nf.ce_locations": _overwritten("location_id", _LOCATION, True),
    "bl_3nf.ce_products": _overwritten("product_id", _PRODUCT, True),
    "bl_3nf.ce_employees": _overwritten("employee_id", "employee_src_id employee_name", True),
    "bl_3nf.ce_payments": _overwritten("payment_id", "payment_src_id payment_type", True),
    "bl_3nf.ce_ship_modes": _overwritten("ship_mode_id", "ship_mode_src_id ship_mode", True),
    "bl_3nf.ce_returned": _overwritten("returned_id", "returned_src_id returned", True),
}

CALENDAR_SCHEMA = T.StructType(
    columns(LONG, "date_surr_id")
    + columns(DATE, "date")
    + columns(INT, "day_of_week")
    + columns(TEXT, "day_name")
    + columns(INT, "month")
    + columns(TEXT, "month_name")
    + columns(INT, "quarter year is_weekend")
)

# One row per sale.
FACT_SCHEMA = T.StructType(
    columns(
        LONG,
        "customer_surr_id location_surr_id product_surr_id employee_surr_id order_date_surr_id "
        "ship_date_surr_id payment_surr_id ship_mode_surr_id returned_surr_id",
    )
    + columns(TEXT, "order_id payment_id")
    + columns(MONEY, "sales")
    + columns(INT, "quantity")
    + columns(MONEY, "discount profit profit_ratio")
    + columns(DATE, "insert_dt update_dt")
)

STAR_SCHEMAS = {
    "bl_dm.dim_customers_scd": _versioned(
        "customer_surr_id", "customer_src_id customer_name customer_segment", False
    ),
    "bl_dm.dim_locations": _overwritten("location_surr_id", _LOCATION, False),
    "bl_dm.dim_products": _overwritten("product_surr_id", _PRODUCT, False),
    "bl_dm.dim_employees": _overwritten("employee_surr_id", "employee_src_id employee_name", False),
    "bl_dm.dim_payments": _overwritten("payment_surr_id", "payment_src_id payment_type", False),
    "bl_dm.dim_ship_modes": _overwritten("ship_mode_surr_id", "ship_mode_src_id ship_mode", False),
    "bl_dm.dim_returned": _overwritten("returned_surr_id", "returned_src_id returned", False),
    "bl_dm.dim_time_day": CALENDAR_SCHEMA,
    "bl_dm.fct_sales_dd": FACT_SCHEMA,
}

LOAD_LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", LONG, False),
        T.StructField("log_datetime", T.TimestampNTZType(), False),
        short_text("procedure_name", 255, nullable=False),
        short_text("target_table", 255),
        T.StructField("rows_affected", LONG),
        short_text("status", 50, nullable=False),
        T.StructField("message", TEXT),
        short_text("error_code", 50),
        T.StructField("error_message", TEXT),
    ]
)

STAGING_SCHEMAS = {
    "sa_cash_sales.src_cash_sales": staging_schema(CASH_COLUMNS),
    "sa_card_sales.src_card_sales": staging_schema(CARD_COLUMNS),
}

# Tables whose rows lie in one folder per staging batch.
BATCHED_TABLES = frozenset([*STAGING_SCHEMAS, "bl_dm.fct_sales_dd"])

# Up to which staging batch a table has been loaded; the newest entry counts.
LOAD_MARK_SCHEMA = T.StructType(
    [T.StructField("mark_id", LONG, False), T.StructField("target_table", TEXT), T.StructField("batch", LONG)]
)

# Survivors of all customer rows staged so far.
SURVIVOR_SCHEMA = T.StructType(
    columns(TEXT, "customer_src_id") + columns(INT, "priority") + columns(TEXT, "customer_name customer_segment")
)

# Staging rows set aside because a value does not fit its type.
REJECTED_SCHEMA = T.StructType(
    [
        T.StructField("batch", LONG),
        T.StructField("source_table", TEXT),
        T.StructField("row_text", TEXT),
        T.StructField("reasons", T.ArrayType(TEXT)),
    ]
)

TABLE_SCHEMAS = {
    **STAGING_SCHEMAS,
    **ENTITY_SCHEMAS,
    **STAR_SCHEMAS,
    "bl_cl.load_log": LOAD_LOG_SCHEMA,
    "bl_cl.load_marks": LOAD_MARK_SCHEMA,
    "bl_cl.customer_survivors": SURVIVOR_SCHEMA,
    "bl_cl.rejected_sales": REJECTED_SCHEMA,
}

# Surrogate id and business key: the first two columns of every entity and dimension.
TABLE_KEYS = {
    table: (schema.names[0], schema.names[1])
    for table, schema in {**ENTITY_SCHEMAS, **STAR_SCHEMAS}.items()
    if schema not in (FACT_SCHEMA, CALENDAR_SCHEMA)
}
TABLE_KEYS["bl_dm.dim_time_day"] = ("date_surr_id", "date_surr_id")
TABLE_KEYS["bl_cl.customer_survivors"] = ("customer_src_id", "customer_src_id")
