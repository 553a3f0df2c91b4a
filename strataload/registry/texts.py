"""SQL texts of the derived inputs, shared by the Spark queries and the check queries."""

from __future__ import annotations

import re
from dataclasses import dataclass

SOURCE_FILTER = {"cash": "l_linestatus = 'F'", "card": "l_linestatus = 'O'"}


@dataclass(frozen=True)
class Lookup:
    prefix: str
    table: str
    condition: str
    line_key: str | None
    serves: tuple[str, ...]


# In join order; ``serves`` names the column prefixes that need the lookup.
LOOKUPS = [
    Lookup("o", "orders", "l_orderkey = o_orderkey", "l_orderkey", ("o", "c", "n", "r")),
    Lookup("c", "customer", "o_custkey = c_custkey", None, ("c", "n", "r")),
    Lookup("n", "nation", "c_nationkey = n_nationkey", None, ("n", "r")),
    Lookup("r", "region", "n_regionkey = r_regionkey", None, ("r",)),
    Lookup("p", "part", "l_partkey = p_partkey", "l_partkey", ("p",)),
    Lookup("s", "supplier", "l_suppkey = s_suppkey", "l_suppkey", ("s",)),
]


@dataclass(frozen=True)
class SalesColumn:
    text: str

    @property
    def needs(self) -> set[str]:
        return {m.group(1) for m in re.finditer(r"\b([ocnrps])_[a-z]", self.text)}

    @property
    def line_columns(self) -> set[str]:
        return set(re.findall(r"\bl_[a-z]+", self.text))


def _padded(key: str) -> str:
    return f"CASE WHEN l_returnflag = 'A' THEN '  ' || CAST({key} AS STRING) || ' ' ELSE CAST({key} AS STRING) END"


_MONEY = "DECIMAL(18,4)"

SALES = {
    name: SalesColumn(text)
    for name, text in {
        "payment_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "order_id": "CAST(l_orderkey AS STRING)",
        "order_date": "CAST(o_orderdate AS DATE)",
        "ship_date": "CAST(l_shipdate AS DATE)",
        "ship_mode": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END",
        "customer_id": _padded("o_custkey"),
        "customer_name": "CASE WHEN c_acctbal < 0 THEN '   ' "
        "WHEN l_linestatus = 'O' AND c_mktsegment = 'MACHINERY' THEN lower(c_name) "
        "WHEN l_returnflag = 'R' AND c_mktsegment = 'FURNITURE' THEN upper(c_name) ELSE c_name END",
        "segment": "CASE WHEN c_mktsegment = 'HOUSEHOLD' AND l_linestatus = 'O' THEN NULL ELSE c_mktsegment END",
        "country": "n_name",
        "city": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE n_name || ' City' END",
        "state": "c_mktsegment",
        "postal_code": "lpad(CAST(n_nationkey * 10 + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS STRING), 5, '0')",
        "region": "CASE WHEN r_name = 'AFRICA' THEN NULL ELSE r_name END",
        "product_id": _padded("l_partkey"),
        "category": "p_type",
        "sub_category": "CASE WHEN p_brand = 'Brand#11' THEN NULL ELSE p_brand END",
        "product_name": "CASE WHEN p_size > 45 THEN '' WHEN l_returnflag = 'R' THEN upper(p_name) ELSE p_name END",
        "sales": f"CAST(l_extendedprice AS {_MONEY})",
        "quantity": "CAST(l_quantity AS INT)",
        "discount": f"CAST(l_discount AS {_MONEY})",
        "profit": f"CAST(CAST(l_extendedprice AS {_MONEY}) * (1 - CAST(l_discount AS DECIMAL(5,4))) "
        f"- CAST(l_quantity AS INT) * 900 AS {_MONEY})",
        "returned": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END",
        "employee_name": "CASE WHEN s_acctbal < 0 THEN '  ' "
        "WHEN l_returnflag = 'R' AND s_acctbal > 5000 THEN upper(s_name) ELSE s_name END",
        "employee_id": _padded("l_suppkey"),
        "payment_type": "CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END",
    }.items()
}

_LABELS = "'SA_CASH_SALES/SA_CARD_SALES' AS source_system, 'SRC_CASH_SALES/SRC_CARD_SALES' AS source_entity"
_DATES = "DATE '2023-01-01' AS insert_dt, DATE '2023-01-01' AS update_dt"
_LOW = "DATE '1900-01-01', DATE '1900-01-01'"
# The region the earlier loads did not cover yet.
_COVERED = "n_regionkey <> 2"


# The unknown member is read from a table like any stored row. As a literal, its key would let the
# optimizer turn the join on that one row into a nested loop.
_UNKNOWN_KEY = "CAST(-1 - r_regionkey AS BIGINT)"
_UNKNOWN_FROM = "FROM {region} WHERE r_regionkey = 0"


def _default(n_text: int, label: str = "MANUAL") -> str:
    texts = ", ".join(["'N/A'"] * n_text)
    return f"UNION ALL SELECT {_UNKNOWN_KEY}, {texts}, '{label}', '{label}', 'N/A', {_LOW} {_UNKNOWN_FROM}"


def _ship_modes(where: str) -> str:
    return (
        "SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS ship_mode_id, "
        "o_orderpriority AS ship_mode_src_id, o_orderpriority AS ship_mode, "
        f"{_LABELS}, o_orderpriority AS source_id, {_DATES} FROM {{orders}} {where} {_default(2)}"
    )


def _payments(where: str) -> str:
    return (
        "SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS payment_id, o_orderstatus AS payment_src_id, "
        f"o_orderstatus AS payment_type, {_LABELS}, o_orderstatus AS source_id, {_DATES} "
        f"FROM {{orders}} {where} {_default(2)}"
    )


def _returned(where: str) -> str:
    return (
        "SELECT DISTINCT CAST(ascii(l_returnflag) AS BIGINT) AS returned_id, l_returnflag AS returned_src_id, "
        "l_returnflag AS returned, 'SA_CARD_SALES' AS source_system, 'SRC_CARD_SALES' AS source_entity, "
        f"l_returnflag AS source_id, {_DATES} FROM {{lineitem}} {where} {_default(2)}"
    )


def _locations(where: str, separator: str = "_") -> str:
    city = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE n_name || ' City' END"
    region = SALES["region"].text
    postal = SALES["postal_code"].text
    parts = ["n_name", f"coalesce({city}, 'N/A')", "c_mktsegment"]
    if separator == "|":
        parts += [postal, f"coalesce({region}, 'N/A')"]
    key = f" || '{separator}' || ".join(parts)
    return (
        "SELECT DISTINCT CAST(n_nationkey * 10000 + ascii(c_mktsegment) * 100 "
        "+ CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS location_id, "
        f"{key} AS location_src_id, n_name AS country, {city} AS city, c_mktsegment AS state, {postal} AS postal_code, "
        f"{region} AS region, {_LABELS}, {key} AS source_id, {_DATES} "
        "FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey "
        f"JOIN {{region}} ON n_regionkey = r_regionkey {where} {_default(6)}"
    )


def _employees(where: str) -> str:
    return (
        "SELECT s_suppkey + 1 AS employee_id, CAST(s_suppkey AS STRING) AS employee_src_id, s_name AS employee_name, "
        f"{_LABELS}, CAST(s_suppkey AS STRING) AS source_id, {_DATES} "
        f"FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey {where} {_default(2)}"
    )


def _products(where: str) -> str:
    return (
        "SELECT p_partkey + 1 AS product_id, CAST(p_partkey AS STRING) AS product_src_id, "
        "CASE WHEN p_size > 45 THEN '' ELSE ' ' || p_name END AS product_name, p_type AS category, "
        f"CASE WHEN p_brand = 'Brand#11' THEN NULL ELSE p_brand END AS sub_category, {_LABELS}, "
        f"CAST(p_partkey AS STRING) AS source_id, {_DATES} FROM {{part}} {where} {_default(4)}"
    )


def _customers(where: str) -> str:
    return (
        "SELECT c_custkey + 1 AS customer_id, CASE WHEN c_mktsegment = 'AUTOMOBILE' "
        "THEN ' ' || CAST(c_custkey AS STRING) || ' ' ELSE CAST(c_custkey AS STRING) END AS customer_src_id, "
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS customer_name, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS customer_segment, "
        f"{_LABELS}, CAST(NULL AS STRING) AS source_id, DATE '2023-01-01' AS start_dt, "
        "CASE WHEN c_acctbal > 9500 THEN DATE '2023-06-30' ELSE DATE '9999-12-31' END AS end_dt, "
        "CASE WHEN c_acctbal > 9500 THEN 'N' WHEN c_acctbal > 9000 THEN 'y' ELSE 'Y' END AS is_active, "
        "DATE '2023-01-01' AS insert_dt "
        f"FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey {where} "
        f"UNION ALL SELECT {_UNKNOWN_KEY}, 'N/A', 'N/A', 'N/A', 'MANUAL', 'MANUAL', CAST(NULL AS STRING), "
        f"DATE '1900-01-01', DATE '9999-12-31', 'Y', DATE '1900-01-01' {_UNKNOWN_FROM}"
    )


# "prior": the entity before the load; "full": as it stands when everything has been loaded.
CE_TEXTS = {
    "ship_modes": {
        "prior": _ship_modes("WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"),
        "full": _ship_modes(""),
    },
    "payments": {"prior": _payments("WHERE o_orderstatus = 'F'"), "full": _payments("")},
    "returned": {"prior": _returned("WHERE l_returnflag = 'R'"), "full": _returned("")},
    "locations": {
        "prior": _locations(f"WHERE {_COVERED}"),
        "full": _locations(""),
        "prior_wide_key": _locations(f"WHERE {_COVERED}", "|"),
    },
    "employees": {"prior": _employees(f"WHERE {_COVERED}"), "full": _employees("")},
    "products": {"prior": _products("WHERE p_type <> 'PROMO'"), "full": _products("")},
    "customers_scd": {"prior": _customers(f"WHERE {_COVERED}"), "full": _customers("")},
}

_DIM_DATES = "DATE '2022-06-01' AS insert_dt, DATE '2022-06-01' AS update_dt"


def _dim_default(n_text: int) -> str:
    texts = ", ".join(["'N/A'"] * (n_text + 2))
    return f"UNION ALL SELECT {_UNKNOWN_KEY}, {texts}, {_LOW} {_UNKNOWN_FROM}"


def _dim(name: str, columns: list[str], changed: str, new_value: str, condition: str) -> str:
    """A dimension as an earlier load left it, with one attribute that has changed since."""
    surrogate, key, *attributes = columns
    id_column = surrogate.replace("_surr_id", "_id")
    selected = [
        f"CASE WHEN {condition} THEN {new_value} ELSE coalesce(nullif(trim({a}), ''), 'N/A') END AS {a}"
        if a == changed
        else f"coalesce(nullif(trim({a}), ''), 'N/A') AS {a}"
        for a in attributes
    ]
    return (
        f"SELECT {id_column} AS {surrogate}, trim({key}) AS {key}, {', '.join(selected)}, source_system, "
        f"source_entity, {_DIM_DATES} FROM ({CE_TEXTS[name]['prior']}) AS earlier WHERE {id_column} <> -1 "
        f"{_dim_default(len(attributes) + 1)}"
    )


_CUSTOMER_DIM = (
    "SELECT customer_id AS customer_surr_id, trim(customer_src_id) AS customer_src_id, "
    "coalesce(nullif(trim(customer_name), ''), 'N/A') AS customer_name, "
    "coalesce(nullif(trim(customer_segment), ''), 'N/A') AS customer_segment, source_system, source_entity, "
    "start_dt, end_dt, coalesce(nullif(upper(trim(is_active)), ''), 'Y') AS is_active, insert_dt "
    f"FROM ({CE_TEXTS['customers_scd']['prior']}) AS earlier WHERE customer_id <> -1 "
    f"UNION ALL SELECT {_UNKNOWN_KEY}, 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', DATE '1900-01-01', "
    f"DATE '9999-12-31', 'Y', DATE '1900-01-01' {_UNKNOWN_FROM}"
)

# Two versions per customer over the years of the orders; the years before the first have none.
CUSTOMER_HISTORY_TEXT = (
    "SELECT customer_surr_id, customer_src_id, DATE '1996-01-01' AS start_dt, DATE '1998-12-31' AS end_dt "
    f"FROM ({_CUSTOMER_DIM}) AS first_version WHERE customer_surr_id <> -1 "
    "UNION ALL SELECT 1000000000 + customer_surr_id, customer_src_id, DATE '1999-01-01', DATE '9999-12-31' "
    f"FROM ({_CUSTOMER_DIM}) AS second_version WHERE customer_surr_id <> -1"
)

DIM_COLUMNS = {
    "ship_modes": ["ship_mode_surr_id", "ship_mode_src_id", "ship_mode"],
    "payments": ["payment_surr_id", "payment_src_id", "payment_type"],
    "returned": ["returned_surr_id", "returned_src_id", "returned"],
    "locations": ["location_surr_id", "location_src_id", "country", "city", "state", "postal_code", "region"],
    "employees": ["employee_surr_id", "employee_src_id", "employee_name"],
    "products": ["product_surr_id", "product_src_id", "product_name", "category", "sub_category"],
}

DIM_TEXTS = {
    "ship_modes": _dim("ship_modes", DIM_COLUMNS["ship_modes"], "ship_mode", "'HIGH'", "ship_mode = '2-HIGH'"),
    "payments": _dim("payments", DIM_COLUMNS["payments"], "payment_type", "NULL", "payment_type = 'F'"),
    "returned": _dim("returned", DIM_COLUMNS["returned"], "returned", "'r'", "returned = 'R'"),
    "locations": _dim("locations", DIM_COLUMNS["locations"], "region", "NULL", "state = 'MACHINERY'"),
    "employees": _dim(
        "employees", DIM_COLUMNS["employees"], "employee_name", "lower(employee_name)", "employee_src_id < '5'"
    ),
    "products": _dim("products", DIM_COLUMNS["products"], "category", "'RARE'", "category = 'LARGE'"),
    "customers_scd": _CUSTOMER_DIM,
}

LOG_TEXT = (
    "SELECT event_id AS log_id, ts AS log_datetime, event_type AS procedure_name, "
    "'bl_dm.' || event_type AS target_table, CAST(floor(value) AS BIGINT) AS rows_affected, "
    "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status, props AS message, "
    "CASE WHEN event_type = 'error' THEN 'P0001' END AS error_code, "
    "CASE WHEN event_type = 'error' THEN props END AS error_message FROM {events}"
)


def sales_text(source: str, names: list[str]) -> str:
    """Staging rows of one source system for the check engine."""
    joins = " ".join(f"LEFT JOIN {{{lk.table}}} ON {lk.condition}" for lk in LOOKUPS)
    columns = ", ".join(f"{SALES[name].text} AS {name}" for name in names)
    return f"SELECT {columns} FROM {{lineitem}} {joins} WHERE {SOURCE_FILTER[source]}"


def plain(text: str) -> str:
    """The text with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", text)

# The day dimension as an earlier load left it: order days without their attributes, and the days of
# the event table, which no sale mentions.
_DAY_KEY = "CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT)"
CALENDAR_TEXT = (
    f"SELECT DISTINCT {_DAY_KEY} AS date_surr_id, d AS date, 0 AS day_of_week, 'N/A' AS day_name, month(d) AS month, "
    "'N/A' AS month_name, quarter(d) AS quarter, year(d) AS year, 0 AS is_weekend FROM ("
    "SELECT CAST(o_orderdate AS DATE) AS d FROM {orders} WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT CAST(ts AS DATE) FROM {events}) AS days "
    f"UNION ALL SELECT {_UNKNOWN_KEY}, DATE '1900-01-01', 0, 'N/A', 0, 'N/A', 0, 0, 0 {_UNKNOWN_FROM}"
)

# Customer versions with flaws: household customers have a second active version, and it starts on
# the day of the first.
FLAWED_TEXT = (
    f"SELECT * FROM ({CE_TEXTS['customers_scd']['prior']}) AS earlier UNION ALL "
    "SELECT -1 - customer_id, customer_src_id, customer_name, 'SECOND', source_system, source_entity, "
    f"source_id, start_dt, end_dt, is_active, insert_dt FROM ({CE_TEXTS['customers_scd']['prior']}) AS again "
    "WHERE customer_segment = 'HOUSEHOLD'"
)
