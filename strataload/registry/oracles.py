"""The same results in SQL, for the check engine."""

from __future__ import annotations

from strataload.registry.texts import (
    CALENDAR_TEXT,
    CE_TEXTS,
    CUSTOMER_HISTORY_TEXT,
    DIM_COLUMNS,
    DIM_TEXTS,
    FLAWED_TEXT,
    LOG_TEXT,
    plain,
    sales_text,
)
from strataload.sources.schemas import CARD_COLUMNS, CASH_COLUMNS, STAGING_TYPES

AS_OF = "DATE '2024-01-01'"
HIGH = "DATE '9999-12-31'"
BOTH = "'SA_CASH_SALES/SA_CARD_SALES' AS source_system, 'SRC_CASH_SALES/SRC_CARD_SALES' AS source_entity"
CASH = "'SA_CASH_SALES' AS source_system, 'SRC_CASH_SALES' AS source_entity"
CARD = "'SA_CARD_SALES' AS source_system, 'SRC_CARD_SALES' AS source_entity"

ENTITY = {
    # name: (id, key, stored attributes, staging columns of the attributes, staging columns of the key)
    "ship_modes": ("ship_mode_id", "ship_mode_src_id", ["ship_mode"], ["ship_mode"], ["ship_mode"]),
    "returned": ("returned_id", "returned_src_id", ["returned"], ["returned"], ["returned"]),
    "payments": ("payment_id", "payment_src_id", ["payment_type"], ["payment_type"], ["payment_type"]),
    "locations": (
        "location_id",
        "location_src_id",
        ["country", "city", "state", "postal_code", "region"],
        ["country", "city", "state", "postal_code", "region"],
        ["country", "city", "state"],
    ),
    "employees": ("employee_id", "employee_src_id", ["employee_name"], ["employee_name"], ["employee_id"]),
    "products": (
        "product_id",
        "product_src_id",
        ["product_name", "category", "sub_category"],
        ["product_name", "category", "sub_category"],
        ["product_id"],
    ),
    "customers_scd": (
        "customer_id",
        "customer_src_id",
        ["customer_name", "customer_segment"],
        ["customer_name", "segment"],
        ["customer_id"],
    ),
}


def clean(column: str) -> str:
    return f"coalesce(nullif(trim({column}), ''), 'N/A')"


def fold(column: str) -> str:
    return f"coalesce({column}, 'N/A')"


def sources(name: str) -> str:
    """CTEs cash and card with the columns an entity needs."""
    _, _, _, attributes, keys = ENTITY[name]
    names = list(dict.fromkeys([*keys, *attributes]))
    card = plain(sales_text("card", names))
    cash = plain(sales_text("cash", names)) if name != "returned" else card
    return f"cash AS ({cash}), card AS ({card})"


def prior(name: str, state: str = "prior") -> str:
    return plain(CE_TEXTS[name][state])


def survivors(name: str) -> str:
    """One row per trimmed key: cash before card, then the smallest attributes."""
    _, key, stored, attributes, (key_column,) = ENTITY[name]
    shaped = ", ".join(f"{clean(a)} AS {s}" for s, a in zip(stored, attributes))
    parts = [
        f"SELECT {rank} AS pr, trim({key_column}) AS {key}, {shaped} FROM {source} "
        f"WHERE nullif(trim({key_column}), '') IS NOT NULL"
        for rank, source in ((1, "cash"), (2, "card"))
    ]
    order = ", ".join(stored)
    return (
        f"SELECT {key}, {order} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY pr, {order}) AS rn "
        f"FROM ({' UNION ALL '.join(parts)}) AS u) AS ranked WHERE rn = 1"
    )


def maxima(name: str) -> str:
    _, key, stored, attributes, (key_column,) = ENTITY[name]
    columns = ", ".join([key_column, *attributes])
    maxed = ", ".join(f"coalesce(max({a}), 'N/A') AS {s}" for s, a in zip(stored, attributes))
    return (
        f"SELECT {fold(key_column)} AS {key}, {maxed} FROM (SELECT {columns} FROM cash UNION ALL "
        f"SELECT {columns} FROM card) AS u GROUP BY {fold(key_column)}"
    )


def entity_delta(name: str, release: str) -> str:
    id_column, key, stored, attributes, keys = ENTITY[name]
    names = ", ".join(stored)
    order = key
    labels = CARD if name == "returned" else BOTH
    state = "prior_wide_key" if (name, release) == ("locations", "v2") else "prior"

    def union(shape: list[str]) -> str:
        return " UNION ".join(f"SELECT {', '.join(shape)} FROM {source}" for source in ("cash", "card"))

    if release == "v1":
        raw_key = keys[0] if len(keys) == 1 else f"concat({keys[0]}, '_', {keys[1]}, '_', {keys[2]})"
        source = union([f"{raw_key} AS {key}", *[f"{a} AS {s}" for s, a in zip(stored, attributes)]])
        # A list with a NULL lets nothing through, an empty list everything.
        match = f"{key} NOT IN (SELECT {key} FROM target WHERE {id_column} <> -1)"
        order = "country, city, state, postal_code, region" if name == "locations" else ", ".join([key, *stored])
        labels = CARD if name == "returned" else CASH
        base = "0"
    else:
        if release == "v2" and name in ("employees", "products"):
            source = maxima(name)
        elif name == "products":
            source = survivors(name)
        elif name == "employees":
            shape = [f"trim(employee_id) AS {key}", f"{clean('employee_name')} AS employee_name"]
            source = " UNION ".join(
                f"SELECT {', '.join(shape)} FROM {s} WHERE nullif(trim(employee_id), '') IS NOT NULL"
                for s in ("cash", "card")
            )
        elif name == "locations":
            parts = stored if release == "v2" else keys
            text = f"concat_ws('{'|' if release == 'v2' else '_'}', {', '.join(fold(p) for p in parts)})"
            source = union([f"{text} AS {key}", *[f"{fold(a)} AS {s}" for s, a in zip(stored, attributes)]])
        else:
            source = union([f"{fold(keys[0])} AS {key}", *[f"{fold(a)} AS {s}" for s, a in zip(stored, attributes)]])
        on = f"t.{key} = s.{key}"
        if (name, release) == ("locations", "v3"):
            on = " AND ".join(f"{fold('t.' + a)} = s.{a}" for a in stored)
            order = f"{key}, postal_code"
        match = f"NOT EXISTS (SELECT 1 FROM target AS t WHERE {on})"
        order = ", ".join(dict.fromkeys([*order.split(", "), *stored]))
        base = f"(SELECT coalesce(max({id_column}), 0) FROM target WHERE {id_column} <> -1)"
    if name == "customers_scd":
        tail = f"{AS_OF} AS start_dt, {HIGH} AS end_dt, 'Y' AS is_active, {AS_OF} AS insert_dt"
    else:
        tail = f"{AS_OF} AS insert_dt, {AS_OF} AS update_dt"
    source_id = "" if release == "v1" else f"{key} AS source_id, "
    folded = ", ".join(f"{fold(s)} AS {s}" for s in stored)
    return (
        f"WITH {sources(name)}, target AS ({prior(name, state)}), s AS ({source}), "
        f"fresh AS (SELECT * FROM s WHERE {match}), "
        f"numbered AS (SELECT *, {base} + row_number() OVER (ORDER BY {order}) AS n FROM fresh) "
        f"SELECT n AS {id_column}, {key}, {folded}, {labels}, {source_id}{tail} FROM numbered"
    )


def staged(source: str, extra: str = "") -> str:
    names = CASH_COLUMNS if source == "cash" else CARD_COLUMNS
    order = ", ".join(n for n in names if n != "payment_id")
    return (
        f"SELECT {', '.join(names)} FROM (SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY {order}) AS rn "
        f"FROM ({plain(sales_text(source, names))}) AS raw) AS ranked WHERE rn = 1 {extra}"
    )


# Version history

CHANGES = (
    f"{sources('customers_scd')}, target AS ({prior('customers_scd')}), s AS ({survivors('customers_scd')}), "
    "active AS (SELECT customer_id, trim(customer_src_id) AS k, "
    f"{clean('customer_name')} AS n, {clean('customer_segment')} AS g FROM target "
    "WHERE customer_id <> -1 AND upper(trim(coalesce(is_active, ''))) = 'Y'), "
    "changes AS (SELECT CASE WHEN a.customer_id IS NULL THEN 'NEW' ELSE 'CHANGED' END AS change_type, "
    "a.customer_id AS current_customer_id, "
    "(SELECT coalesce(max(customer_id), 0) FROM target WHERE customer_id <> -1) + row_number() OVER ("
    "ORDER BY s.customer_src_id) AS new_customer_id, s.* FROM s LEFT JOIN active AS a ON a.k = s.customer_src_id "
    "WHERE a.customer_id IS NULL OR a.n IS DISTINCT FROM s.customer_name OR a.g IS DISTINCT FROM s.customer_segment)"
)
CHANGE_COLUMNS = (
    f"change_type, current_customer_id, new_customer_id, customer_src_id, customer_name, customer_segment, {BOTH}"
)
CUSTOMER_TAIL = "customer_src_id, customer_name, customer_segment, source_system, source_entity"
AFTER = (
    "after AS ("
    "SELECT customer_id, customer_src_id, customer_name, customer_segment, source_system, source_entity, source_id, "
    "start_dt, CASE WHEN gone THEN DATE '2023-12-31' ELSE end_dt END AS end_dt, "
    "CASE WHEN gone THEN 'N' ELSE is_active END AS is_active, insert_dt FROM (SELECT t.*, customer_id IN ("
    "SELECT current_customer_id FROM changes WHERE change_type = 'CHANGED') AS gone FROM target AS t) AS m "
    "UNION ALL SELECT new_customer_id, customer_src_id, customer_name, customer_segment, "
    "'SA_CASH_SALES/SA_CARD_SALES', 'SRC_CASH_SALES/SRC_CARD_SALES', NULL, "
    f"{AS_OF}, {HIGH}, 'Y', {AS_OF} FROM changes)"
)


def two_step() -> str:
    return (
        f"WITH {sources('customers_scd')}, target AS ({prior('customers_scd')}), s AS ({maxima('customers_scd')}), "
        "marked AS (SELECT t.*, coalesce(t.is_active = 'Y' AND t.customer_id <> -1 AND s.customer_src_id IS NOT NULL "
        f"AND ({fold('t.customer_name')} <> s.customer_name OR {fold('t.customer_segment')} <> s.customer_segment), "
        "false) AS gone FROM target AS t LEFT JOIN s ON s.customer_src_id = t.customer_src_id), "
        "fresh AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM target AS t WHERE t.is_active = 'Y' "
        f"AND t.customer_src_id = s.customer_src_id AND {fold('t.customer_name')} = s.customer_name "
        f"AND {fold('t.customer_segment')} = s.customer_segment)) "
        f"SELECT customer_id, {CUSTOMER_TAIL}, source_id, start_dt, "
        "CASE WHEN gone THEN DATE '2023-12-31' ELSE end_dt END AS end_dt, "
        "CASE WHEN gone THEN 'N' ELSE is_active END AS is_active, insert_dt FROM marked UNION ALL "
        "SELECT (SELECT max(customer_id) FROM target) + row_number() OVER (ORDER BY customer_src_id), "
        "customer_src_id, customer_name, customer_segment, 'SA_CASH_SALES/SA_CARD_SALES', "
        f"'SRC_CASH_SALES/SRC_CARD_SALES', customer_src_id, {AS_OF}, {HIGH}, 'Y', {AS_OF} FROM fresh"
    )


# Star schema


def merged(target: str, source: str, columns: list[str], compared: list[str], stamped: bool, ctes: str = "") -> str:
    """State after an upsert by full outer join, with the action per row."""
    key = columns[0]
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compared)
    chosen = []
    for column in columns:
        updated = f"s.{column}"
        if stamped and column == "insert_dt":
            updated = "t.insert_dt"
        elif stamped and column == "update_dt":
            updated = AS_OF
        chosen.append(
            f"CASE WHEN a = 'insert' THEN s_{column} WHEN a = 'update' THEN u_{column} ELSE t_{column} END AS {column}"
        )
        columns_sql = f"s.{column} AS s_{column}, {updated} AS u_{column}, t.{column} AS t_{column}"
        chosen[-1] = (chosen[-1], columns_sql)
    inner = ", ".join(sql for _, sql in chosen)
    return (
        f"WITH {ctes + ', ' if ctes else ''}dim AS ({target}), src AS ({source}), joined AS (SELECT {inner}, "
        f"CASE WHEN t.{key} IS NULL THEN 'insert' WHEN s.{key} IS NULL THEN 'keep' WHEN {differs} THEN 'update' "
        f"ELSE 'keep' END AS a FROM dim AS t FULL JOIN src AS s ON t.{key} = s.{key}) "
        f"SELECT {', '.join(outer for outer, _ in chosen)}, a AS merge_action FROM joined"
    )


def dimension_source(name: str, entity: str) -> str:
    surrogate, key, *attributes = DIM_COLUMNS[name]
    id_column = surrogate.replace("_surr_id", "_id")
    cleaned = ", ".join(f"{clean(c)} AS {c}" for c in [*attributes, "source_system", "source_entity"])
    return (
        f"SELECT {id_column} AS {surrogate}, trim({key}) AS {key}, {cleaned}, "
        f"coalesce(insert_dt, {AS_OF}) AS insert_dt, coalesce(update_dt, {AS_OF}) AS update_dt "
        f"FROM ({entity}) AS e WHERE {id_column} <> -1"
    )


def dim_upsert(name: str) -> str:
    columns = [*DIM_COLUMNS[name], "source_system", "source_entity"]
    source = dimension_source(name, prior(name, "full"))
    return merged(plain(DIM_TEXTS[name]), source, [*columns, "insert_dt", "update_dt"], columns[1:], True)


CUSTOMER_DIM_COLUMNS = [
    "customer_surr_id", "customer_src_id", "customer_name", "customer_segment", "source_system", "source_entity",
    "start_dt", "end_dt", "is_active", "insert_dt",
]


def customer_dim_source(entity: str) -> str:
    return (
        "SELECT customer_id AS customer_surr_id, trim(customer_src_id) AS customer_src_id, "
        f"{clean('customer_name')} AS customer_name, {clean('customer_segment')} AS customer_segment, "
        f"{clean('source_system')} AS source_system, {clean('source_entity')} AS source_entity, start_dt, end_dt, "
        f"coalesce(nullif(upper(trim(is_active)), ''), 'Y') AS is_active, insert_dt FROM {entity} WHERE customer_id <> -1"
    )


def customer_merge(entity: str, ctes: str = "") -> str:
    return merged(
        plain(DIM_TEXTS["customers_scd"]),
        customer_dim_source(entity),
        CUSTOMER_DIM_COLUMNS,
        CUSTOMER_DIM_COLUMNS[1:],
        False,
        ctes,
    )


CALENDAR_COLUMNS = ["date_surr_id", "date", "day_of_week", "day_name", "month", "month_name", "quarter", "year", "is_weekend"]


def calendar_source(cash: str, card: str) -> str:
    days = " UNION ".join(
        f"SELECT {column} AS d FROM {source} WHERE {column} IS NOT NULL"
        for source in (cash, card)
        for column in ("order_date", "ship_date")
    )
    return (
        "SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_surr_id, d AS date, CAST(isodow(d) AS INT) AS day_of_week, "
        "dayname(d) AS day_name, CAST(month(d) AS INT) AS month, monthname(d) AS month_name, "
        "CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year, "
        f"CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend FROM ({days}) AS observed"
    )


def calendar_merge() -> str:
    days = ["order_date", "ship_date"]
    ctes = f"cash AS ({plain(sales_text('cash', days))}), card AS ({plain(sales_text('card', days))})"
    target = (
        "SELECT date_surr_id, date, CAST(day_of_week AS INT) AS day_of_week, day_name, CAST(month AS INT) AS month, "
        "month_name, CAST(quarter AS INT) AS quarter, CAST(year AS INT) AS year, CAST(is_weekend AS INT) AS is_weekend "
        f"FROM ({plain(CALENDAR_TEXT)}) AS c"
    )
    return merged(target, calendar_source("cash", "card"), CALENDAR_COLUMNS, CALENDAR_COLUMNS[1:], False, ctes)


# Checks

DIMENSION_TABLES = {
    **{f"dim_{name}": (DIM_TEXTS[name], columns[0]) for name, columns in DIM_COLUMNS.items()},
    "dim_customers_scd": (DIM_TEXTS["customers_scd"], "customer_surr_id"),
    "dim_time_day": (CALENDAR_TEXT, "date_surr_id"),
}
FLAWED = f"flawed AS ({plain(FLAWED_TEXT)})"
CUSTOMER_DIM = f"dim AS ({plain(DIM_TEXTS['customers_scd'])})"
HISTORY = (
    "history AS (SELECT 'BL_3NF' AS layer_name, customer_id AS version_id, customer_src_id, customer_name, "
    "customer_segment, start_dt, end_dt, is_active FROM flawed UNION ALL SELECT 'BL_DM', customer_surr_id, "
    "customer_src_id, customer_name, customer_segment, start_dt, end_dt, is_active FROM dim)"
)


def dim_counts() -> str:
    parts = [
        f"SELECT '{name}' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE {key} = -1) AS default_rows, "
        f"count(*) FILTER (WHERE {key} <> -1) AS business_rows FROM ({plain(text)}) AS t"
        for name, (text, key) in DIMENSION_TABLES.items()
    ]
    return " UNION ALL ".join(parts)


def layer_counts() -> str:
    texts = {f"ce_{name}": CE_TEXTS[name]["prior"] for name in ENTITY}
    texts |= {name: text for name, (text, _) in DIMENSION_TABLES.items()}
    parts = [f"SELECT '{n}' AS table_name, count(*) AS row_count FROM ({plain(t)}) AS t" for n, t in texts.items()]
    return " UNION ALL ".join([*parts, "SELECT 'fct_sales_dd', CAST(0 AS BIGINT)"])


def dup_keys() -> str:
    frames = {
        "product_src_id": f"({prior('products', 'full')}) AS t WHERE product_id <> -1",
        "customer_src_id": f"({plain(FLAWED_TEXT)}) AS t WHERE customer_id <> -1 AND is_active = 'Y'",
        "location_src_id": f"({prior('locations', 'full')}) AS t WHERE location_id <> -1",
    }
    return " UNION ALL ".join(
        f"SELECT '{key}' AS key_name, {key} AS key_value, count(*) AS row_count FROM {rows} GROUP BY {key} HAVING count(*) > 1"
        for key, rows in frames.items()
    )


def reconcile() -> str:
    columns = ", ".join(CUSTOMER_DIM_COLUMNS[1:])
    entity = f"SELECT customer_id, {columns} FROM ({prior('customers_scd', 'full')}) AS e"
    dimension = f"SELECT customer_surr_id, {columns} FROM ({plain(DIM_TEXTS['customers_scd'])}) AS d"
    return (
        f"SELECT 'only_in_bl_3nf' AS difference_type, count(*) AS row_count FROM ({entity} EXCEPT {dimension}) AS a "
        f"UNION ALL SELECT 'only_in_bl_dm', count(*) FROM ({dimension} EXCEPT {entity}) AS b"
    )


def both_sales(names: list[str]) -> str:
    return f"cash AS ({plain(sales_text('cash', names))}), card AS ({plain(sales_text('card', names))})"


def outcomes(rerun: bool) -> str:
    """Rows each load must report when all layers start empty; every entity also gains a default row."""
    counts = {
        "ship_modes": f"SELECT {fold('ship_mode')} AS k FROM cash UNION SELECT {fold('ship_mode')} FROM card",
        "returned": f"SELECT {fold('returned')} AS k FROM card",
        "payments": f"SELECT {fold('payment_type')} AS k FROM cash UNION SELECT {fold('payment_type')} FROM card",
    }
    location = ", ".join(f"{fold(c)} AS {c}" for c in ENTITY["locations"][2])
    employee = f"trim(employee_id) AS k, {clean('employee_name')} AS n"
    loaded = {
        name: f"SELECT count(DISTINCT k) FILTER (WHERE k <> 'N/A') FROM ({text}) AS t" for name, text in counts.items()
    }
    loaded |= {
        "locations": f"SELECT count(*) FROM (SELECT {location} FROM cash UNION SELECT {location} FROM card) AS t",
        "employees": f"SELECT count(*) FROM (SELECT {employee} FROM cash UNION SELECT {employee} FROM card) AS t",
        "products": "SELECT count(*) FROM (SELECT trim(product_id) FROM cash UNION SELECT trim(product_id) FROM card) AS t",
        "customers_scd": "SELECT count(*) FROM (SELECT trim(customer_id) FROM cash UNION "
        "SELECT trim(customer_id) FROM card) AS t",
    }
    days = f"SELECT count(*) FROM ({calendar_source('cash', 'card')}) AS t"
    # Two names for one employee id give two entity rows, which the dimension's unique key refuses.
    twice = f"(SELECT count(DISTINCT k) < count(*) FROM (SELECT {employee} FROM cash UNION SELECT {employee} FROM card) AS t)"
    ok = "'SUCCESS' AS status, {message} AS message, CAST(NULL AS VARCHAR) AS error_code"
    rows = []
    for name, text in {**loaded, "time_day": days}.items():
        upper = name.upper()
        if name != "time_day" and not rerun:
            status = ok.format(message=f"'CE_{upper} loaded successfully.'")
            rows.append(
                f"SELECT 'prc_load_ce_{name}' AS procedure_name, 'bl_3nf.ce_{name}' AS target_table, "
                f"({text}) + 1 AS rows_affected, {status}"
            )
        number = "CAST(0 AS BIGINT)" if rerun else f"({text})"
        status = ok.format(message=f"'DIM_{upper} loaded successfully.'")
        if name == "employees":
            number = f"CASE WHEN {twice} THEN 0 ELSE {number} END"
            status = (
                f"CASE WHEN {twice} THEN 'ERROR' ELSE 'SUCCESS' END AS status, CASE WHEN {twice} THEN "
                "'Error while loading DIM_EMPLOYEES.' ELSE 'DIM_EMPLOYEES loaded successfully.' END AS message, "
                f"CASE WHEN {twice} THEN '23505' END AS error_code"
            )
        rows.append(
            f"SELECT 'prc_load_dim_{name}' AS procedure_name, 'bl_dm.dim_{name}' AS target_table, "
            f"{number} AS rows_affected, {status}"
        )
    return f"WITH cash AS ({staged('cash')}), card AS ({staged('card')}) {' UNION ALL '.join(rows)}"


def raw_text(source: str) -> str:
    names = CASH_COLUMNS if source == "cash" else CARD_COLUMNS
    columns = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" if n in STAGING_TYPES else n for n in names)
    return f"SELECT {columns} FROM ({plain(sales_text(source, names))}) AS t"


# Stored rows


def clean_staged(source: str, batches: bool = False) -> str:
    """Staged rows in which every employee has one name, with the half of the orders they belong to."""
    half = ", CAST(order_id AS BIGINT) % 2 AS half" if batches else ""
    return f"SELECT * REPLACE ('Employee ' || trim(employee_id) AS employee_name){half} FROM ({staged(source)}) AS clean"


def first_survivors(name: str) -> str:
    """Survivors by cash before card within the half in which a key first occurs."""
    _, key, stored, attributes, (key_column,) = ENTITY[name]
    shaped = ", ".join(f"{clean(a)} AS {s}" for s, a in zip(stored, attributes))
    parts = " UNION ALL ".join(
        f"SELECT {rank} AS pr, half, trim({key_column}) AS {key}, {shaped} FROM {source}"
        for rank, source in ((1, "cash"), (2, "card"))
    )
    order = ", ".join(stored)
    return (
        f"SELECT {key}, {order} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY half, pr, {order}) AS rn "
        f"FROM ({parts}) AS u) AS r WHERE rn = 1"
    )


def two_halves() -> str:
    """Rows of every entity and dimension after both halves: a key's row is that of its first half."""
    rows = []

    def both(name: str, key: str, entity: list[str], dimension: list[str], source: str, dim_key: str = "") -> None:
        none = "CAST(NULL AS DATE) AS start_dt, CAST(NULL AS DATE) AS end_dt, CAST(NULL AS VARCHAR) AS is_active"
        for table, names in ((f"bl_3nf.ce_{name}", entity), (f"bl_dm.dim_{name}", dimension)):
            column = key if table.startswith("bl_3nf") else (dim_key or key)
            rows.append(
                f"SELECT '{table}' AS table_name, {column} AS business_key, concat_ws('|', {', '.join(names)}) AS attributes, "
                f"{none} FROM ({source}) AS x"
            )

    for name in ("ship_modes", "payments", "returned"):
        _, _, _, (column,), _ = ENTITY[name]
        sides = ["card"] if name == "returned" else ["cash", "card"]
        union = " UNION ".join(f"SELECT {fold(column)} AS k FROM {side}" for side in sides)
        both(name, "k", ["k"], [clean("k")], f"SELECT DISTINCT k FROM ({union}) AS d WHERE k <> 'N/A'", "trim(k)")
    parts = ENTITY["locations"][2]
    shaped = ", ".join(f"{fold(c)} AS {c}" for c in parts)
    union = f"SELECT {shaped} FROM cash UNION SELECT {shaped} FROM card"
    key = "concat_ws('_', country, city, state)"
    both("locations", key, parts, [clean(c) for c in parts], union, f"trim({key})")
    shape = f"trim(employee_id) AS k, {clean('employee_name')} AS n"
    both("employees", "k", ["n"], ["n"], f"SELECT {shape} FROM cash UNION SELECT {shape} FROM card")
    names = ENTITY["products"][2]
    both("products", "product_src_id", names, names, first_survivors("products"))
    later = "DATE '2024-01-02'"
    versions = (
        "SELECT coalesce(o.customer_src_id, n.customer_src_id) AS k, o.customer_src_id IS NOT NULL AS early, "
        "o.customer_name AS on_, o.customer_segment AS os, n.customer_name AS nn, n.customer_segment AS ns, "
        "o.customer_src_id IS NOT NULL AND (o.customer_name <> n.customer_name OR o.customer_segment <> n.customer_segment) "
        "AS changed FROM old_customers AS o FULL JOIN new_customers AS n ON o.customer_src_id = n.customer_src_id"
    )
    for table in ("bl_3nf.ce_customers_scd", "bl_dm.dim_customers_scd"):
        rows.append(
            f"SELECT '{table}', k, concat_ws('|', on_, os), {AS_OF}, CASE WHEN changed THEN {AS_OF} ELSE {HIGH} END, "
            f"CASE WHEN changed THEN 'N' ELSE 'Y' END FROM ({versions}) AS v WHERE early"
        )
        rows.append(
            f"SELECT '{table}', k, concat_ws('|', nn, ns), {later}, {HIGH}, 'Y' FROM ({versions}) AS v WHERE changed OR NOT early"
        )
    old = survivors("customers_scd").replace("FROM cash", "FROM cash0").replace("FROM card", "FROM card0")
    return (
        f"WITH cash AS MATERIALIZED ({clean_staged('cash', True)}), card AS MATERIALIZED ({clean_staged('card', True)}), "
        "cash0 AS (SELECT * FROM cash WHERE half = 0), card0 AS (SELECT * FROM card WHERE half = 0), "
        f"old_customers AS ({old}), new_customers AS ({survivors('customers_scd')}) {' UNION ALL '.join(rows)}"
    )


def loaded() -> str:
    """Customers and products of both layers and the calendar after one load, numbered in text order."""
    none = "CAST(NULL AS DATE) AS start_dt, CAST(NULL AS DATE) AS end_dt, CAST(NULL AS VARCHAR) AS is_active"
    rows = []
    for name, dated in (("products", none), ("customers_scd", f"{AS_OF}, {HIGH}, 'Y'")):
        _, key, stored, _, _ = ENTITY[name]
        for table in (f"bl_3nf.ce_{name}", f"bl_dm.dim_{name}"):
            rows.append(
                f"SELECT '{table}' AS table_name, row_number() OVER (ORDER BY {key}) AS row_id, {key} AS business_key, "
                f"concat_ws('|', {', '.join(stored)}) AS attributes, {dated} FROM s_{name}"
            )
    days = ", ".join(CALENDAR_COLUMNS[2:])
    rows.append(
        f"SELECT 'bl_dm.dim_time_day', date_surr_id, CAST(date AS VARCHAR), concat_ws('|', {days}), {none} "
        f"FROM ({calendar_source('cash', 'card')}) AS t"
    )
    return (
        f"WITH cash AS ({staged('cash')}), card AS ({staged('card')}), s_products AS ({survivors('products')}), "
        f"s_customers_scd AS ({survivors('customers_scd')}) {' UNION ALL '.join(rows)}"
    )


def survivor_states() -> str:
    def ranked(name: str) -> str:
        _, key, stored, attributes, (key_column,) = ENTITY[name]
        shaped = ", ".join(f"{clean(a)} AS {s}" for s, a in zip(stored, attributes))
        parts = " UNION ALL ".join(
            f"SELECT {rank} AS pr, trim({key_column}) AS {key}, {shaped} FROM {source}_{name} "
            f"WHERE nullif(trim({key_column}), '') IS NOT NULL"
            for rank, source in ((1, "cash"), (2, "card"))
        )
        order = ", ".join(stored)
        return (
            f"SELECT '{name}' AS entity_name, {key} AS business_key, CAST(pr AS INT) AS priority, "
            f"concat_ws('|', {order}) AS attributes FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY pr, {order}) AS rn FROM ({parts}) AS u) AS r WHERE rn = 1"
        )

    ctes = ", ".join(
        f"{source}_{name} AS ({plain(sales_text(source, [*ENTITY[name][4], *ENTITY[name][3]]))})"
        for name in ("products", "customers_scd", "employees")
        for source in ("cash", "card")
    )
    most = (
        f"SELECT 'employees', {fold('employee_id')}, CAST(0 AS INT), {fold('max(employee_name)')} FROM (SELECT employee_id, "
        f"employee_name FROM cash_employees UNION ALL SELECT employee_id, employee_name FROM card_employees) AS e "
        f"GROUP BY {fold('employee_id')}"
    )
    return f"WITH {ctes} {ranked('products')} UNION ALL {ranked('customers_scd')} UNION ALL {most}"


def rebuilt() -> str:
    names = ["customer_id", "customer_name", "segment", "order_date", "order_id"]
    events = " UNION ".join(
        f"SELECT trim(customer_id) AS customer_src_id, {clean('customer_name')} AS customer_name, "
        f"{clean('segment')} AS customer_segment, order_date AS d, CAST(order_id AS BIGINT) AS o FROM {side}"
        for side in ("cash", "card")
    )
    return (
        f"WITH {both_sales(names)}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_src_id, d "
        f"ORDER BY o DESC, customer_name DESC, customer_segment DESC) AS rn FROM ({events}) AS e) AS r WHERE rn = 1), "
        "marked AS (SELECT *, row_number() OVER w AS n, lag(customer_name) OVER w AS pn, lag(customer_segment) OVER w AS ps "
        "FROM last WINDOW w AS (PARTITION BY customer_src_id ORDER BY d)), "
        "starts AS (SELECT *, lead(d) OVER (PARTITION BY customer_src_id ORDER BY d) AS following FROM marked "
        "WHERE n = 1 OR customer_name <> pn OR customer_segment <> ps) "
        "SELECT customer_src_id, customer_name, customer_segment, d AS start_dt, "
        f"CASE WHEN following IS NULL THEN {HIGH} ELSE following - 1 END AS end_dt, "
        "CASE WHEN following IS NULL THEN 'Y' ELSE 'N' END AS is_active FROM starts"
    )


def facts() -> str:
    cash = plain(sales_text("cash", CASH_COLUMNS))
    card = plain(sales_text("card", CARD_COLUMNS))
    dims = ", ".join(f"d_{name} AS ({plain(text)})" for name, text in DIM_TEXTS.items() if name != "customers_scd")
    location = " AND ".join(f"l.{c} = {clean('s.' + c)}" for c in ENTITY["locations"][2])
    simple = {"payments": "payment_type", "ship_modes": "ship_mode"}
    joins = [
        "LEFT JOIN history AS c ON trim(c.customer_src_id) = trim(s.customer_id) AND s.order_date BETWEEN c.start_dt AND c.end_dt",
        f"LEFT JOIN d_locations AS l ON l.location_surr_id <> -1 AND {location}",
        "LEFT JOIN d_products AS p ON p.product_surr_id <> -1 AND p.product_src_id = trim(s.product_id)",
        "LEFT JOIN d_employees AS e ON e.employee_surr_id <> -1 AND e.employee_src_id = trim(s.employee_id)",
        "LEFT JOIN d_returned AS r ON r.returned_surr_id <> -1 AND s.by_card AND "
        f"r.returned_src_id = trim({fold('s.returned')})",
        "LEFT JOIN calendar AS o ON o.date_surr_id <> -1 AND o.date = s.order_date",
        "LEFT JOIN calendar AS h ON h.date_surr_id <> -1 AND h.date = s.ship_date",
    ]
    for name, column in simple.items():
        surrogate, key = DIM_COLUMNS[name][:2]
        joins.append(f"LEFT JOIN d_{name} AS {name} ON {name}.{surrogate} <> -1 AND {name}.{key} = trim({fold('s.' + column)})")
    ids = [
        "c.customer_surr_id", "l.location_surr_id", "p.product_surr_id", "e.employee_surr_id", "payments.payment_surr_id",
        "ship_modes.ship_mode_surr_id", "r.returned_surr_id",
    ]
    chosen = ", ".join(f"coalesce({i}, -1) AS {i.split('.')[1]}" for i in ids)
    return (
        f"WITH sales AS (SELECT *, true AS by_card FROM ({card}) AS k UNION ALL BY NAME SELECT *, false AS by_card "
        f"FROM ({cash}) AS k), history AS ({plain(CUSTOMER_HISTORY_TEXT)}), calendar AS ({plain(CALENDAR_TEXT)}), {dims} "
        f"SELECT {chosen}, coalesce(o.date_surr_id, -1) AS order_date_surr_id, coalesce(h.date_surr_id, -1) AS "
        "ship_date_surr_id, s.order_id, s.payment_id, s.sales, s.quantity, s.discount, s.profit, "
        "CASE WHEN s.sales <> 0 THEN CAST(s.profit / s.sales AS DECIMAL(18,4)) END AS profit_ratio, "
        f"{AS_OF} AS insert_dt, {AS_OF} AS update_dt FROM sales AS s {' '.join(joins)}"
    )


def table_checks() -> str:
    active = "upper(trim(coalesce(is_active, ''))) = 'Y'"
    key = "trim(customer_src_id)"
    none = "CAST(NULL AS VARCHAR)"
    counted = [
        ("total_rows", "true"), ("default_rows", "customer_id = -1"), ("business_rows", "customer_id <> -1"),
        ("rows_without_id", "customer_id IS NULL"),
    ]
    rows = [
        f"SELECT '{name}' AS check_name, {none} AS key_1, {none} AS key_2, count(*) FILTER (WHERE {condition}) AS row_count "
        "FROM flawed"
        for name, condition in counted
    ]
    for name, first, second, where in (
        ("primary_key", "CAST(customer_id AS VARCHAR)", none, "true"),
        ("one_active_3nf", key, none, active),
        ("one_active_dm", key, none, f"customer_id <> -1 AND {active}"),
        ("one_version_per_day", key, "CAST(start_dt AS VARCHAR)", "customer_id <> -1"),
        ("unique_key", key, none, "customer_id <> -1"),
    ):
        rows.append(
            f"SELECT '{name}', {first} AS a, {second} AS b, count(*) FROM flawed WHERE {where} GROUP BY a, b HAVING count(*) > 1"
        )
    return f"WITH {FLAWED} {' UNION ALL '.join(rows)}"


def profile() -> str:
    columns = ["customer_id", "customer_name", "product_id", "postal_code", "sales", "quantity"]
    rows = []
    for column in columns:
        number = f"CAST({column} AS DECIMAL(38,4))" if column in STAGING_TYPES else column
        rows.append(
            f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {column} IS NULL) AS null_count, "
            f"count(*) FILTER (WHERE trim(CAST({column} AS VARCHAR)) = '') AS blank_count, CAST(min({number}) AS VARCHAR) "
            f"AS smallest, CAST(max({number}) AS VARCHAR) AS largest, true AS distinct_is_close, true AS median_is_close FROM cash"
        )
    return f"WITH cash AS ({plain(sales_text('cash', columns))}) {' UNION ALL '.join(rows)}"


def quarantined() -> str:
    names = ["payment_id", "order_id", "sales", "quantity"]
    bad_sales, bad_quantity = "CAST(order_id AS BIGINT) % 50 = 7", "CAST(order_id AS BIGINT) % 70 = 7"
    reasons = (
        f"concat_ws('; ', CASE WHEN {bad_sales} THEN 'sales does not fit decimal(18,4): n/a' END, "
        f"CASE WHEN {bad_quantity} THEN 'quantity does not fit int: ' || CAST(quantity AS VARCHAR) || ' pieces' END)"
    )
    return (
        f"SELECT CASE WHEN {bad_sales} OR {bad_quantity} THEN {reasons} ELSE 'typed' END AS outcome, payment_id, "
        f"CASE WHEN {bad_sales} THEN 'n/a' ELSE CAST(sales AS VARCHAR) END AS sales "
        f"FROM ({plain(sales_text('cash', names))}) AS c"
    )


ORACLES: dict[str, str] = {
    "csv_scan": raw_text("cash"),
    "stage_cast_dedup": staged("cash"),
    "stage_card": staged("card"),
    "limit_sample": staged("cash", "ORDER BY payment_id LIMIT 5"),
    "schema_evolve": (
        "SELECT product_id, product_src_id, product_name, category, sub_category, source_system, source_entity, "
        f"CAST(NULL AS VARCHAR) AS source_id, insert_dt, update_dt FROM ({prior('products')}) AS o WHERE product_id <> -1 "
        "UNION ALL SELECT product_id, product_src_id, product_name, category, sub_category, source_system, "
        f"source_entity, source_id, insert_dt, update_dt FROM ({prior('products', 'full')}) AS n WHERE category = 'PROMO'"
    ),
    "range_generate": (
        "SELECT CAST(i AS BIGINT) AS a, CAST(i AS BIGINT) AS b FROM "
        "(SELECT unnest(generate_series(1, (SELECT count(*) FROM lineitem))) AS i) AS g"
    ),
    "generated_counts": (
        "SELECT 'after_first_insert' AS table_name, count(*) AS row_count FROM lineitem UNION ALL "
        "SELECT 'after_second_insert', 6 * count(*) FROM lineitem"
    ),
    **{
        f"{name}_delta{'' if release == 'v3' else '_' + release}": entity_delta(name, release)
        for name in ENTITY
        for release in ("v1", "v2", "v3")
        if name != "customers_scd" or release == "v1"
    },
    "not_in_null_target": entity_delta("products", "v1").replace(
        f"target AS ({prior('products')})",
        "target AS (SELECT product_id, nullif(product_src_id, '0') AS product_src_id "
        f"FROM ({prior('products')}) AS p)",
    ),
    "default_rows": prior("products"),
    "surrogate_keys": (
        f"WITH {both_sales(['payment_id'])}, p AS (SELECT payment_id FROM cash UNION SELECT payment_id FROM card) "
        "SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY payment_id) AS payment_surr_id, "
        "payment_id FROM p"
    ),
    "scd2_changes": f"WITH {CHANGES} SELECT {CHANGE_COLUMNS} FROM changes",
    "scd2_preview": f"WITH {CHANGES} SELECT {CHANGE_COLUMNS} FROM changes WHERE customer_segment = 'BUILDING'",
    "scd2_apply": f"WITH {CHANGES}, {AFTER} SELECT * FROM after",
    "scd2_accounting": (
        f"WITH {CHANGES}, n AS (SELECT count(*) AS opened_rows, count(*) FILTER (WHERE change_type = 'CHANGED') "
        "AS changed_keys FROM changes) SELECT opened_rows, changed_keys, changed_keys AS closed_rows, "
        "opened_rows + changed_keys AS rows_affected FROM n"
    ),
    "scd2_v2_apply": two_step(),
    "scd2_propagate": customer_merge("after", f"{CHANGES}, {AFTER}"),
    "scd2_revert": (
        f"WITH {FLAWED} SELECT customer_id, {CUSTOMER_TAIL}, source_id, start_dt, "
        f"CASE WHEN is_active = 'N' THEN {HIGH} ELSE end_dt END AS end_dt, "
        "CASE WHEN is_active = 'N' THEN 'Y' ELSE is_active END AS is_active, insert_dt FROM flawed "
        "WHERE customer_segment IS DISTINCT FROM 'SECOND'"
    ),
    "layer_history": f"WITH {FLAWED}, {CUSTOMER_DIM}, {HISTORY} SELECT * FROM history",
    "version_summary": (
        f"WITH {FLAWED}, {CUSTOMER_DIM}, {HISTORY} SELECT layer_name, count(*) AS total_versions, "
        "count(*) FILTER (WHERE upper(trim(is_active)) = 'Y') AS active_versions, "
        "count(*) FILTER (WHERE upper(trim(is_active)) = 'N') AS inactive_versions FROM history GROUP BY layer_name"
    ),
    **{f"dim_upsert_{name}": dim_upsert(name) for name in DIM_COLUMNS},
    "dim_upsert_customers_scd": customer_merge(f"({prior('customers_scd', 'full')}) AS e"),
    "dim_product_rows": dimension_source("products", prior("products", "full")),
    "dim_time_day": calendar_merge(),
    "dim_counts": dim_counts(),
    "layer_counts": layer_counts(),
    "dup_keys": dup_keys(),
    "one_active": (
        f"WITH {FLAWED}, {CUSTOMER_DIM} SELECT customer_src_id, count(*) AS active_version_count, 'BL_3NF' AS layer_name "
        "FROM flawed WHERE customer_id <> -1 AND upper(trim(is_active)) = 'Y' GROUP BY customer_src_id "
        "HAVING count(*) <> 1 UNION ALL SELECT customer_src_id, count(*), 'BL_DM' FROM dim "
        "WHERE customer_surr_id <> -1 AND upper(trim(is_active)) = 'Y' GROUP BY customer_src_id HAVING count(*) <> 1"
    ),
    "one_active_index": (
        f"WITH {FLAWED} SELECT trim(customer_src_id) AS key_1, count(*) AS row_count FROM flawed WHERE customer_id <> -1 "
        "AND upper(trim(coalesce(is_active, ''))) = 'Y' GROUP BY trim(customer_src_id) HAVING count(*) > 1"
    ),
    "version_unique": (
        f"WITH {FLAWED} SELECT trim(customer_src_id) AS key_1, start_dt AS key_2, count(*) AS row_count FROM flawed "
        "WHERE customer_id <> -1 GROUP BY trim(customer_src_id), start_dt HAVING count(*) > 1"
    ),
    "key_unique": (
        f"WITH {both_sales(['employee_id', 'employee_name'])}, r AS (SELECT employee_id, employee_name FROM cash UNION "
        "SELECT employee_id, employee_name FROM card) SELECT trim(employee_id) AS key_1, count(*) AS row_count FROM r "
        "GROUP BY trim(employee_id) HAVING count(*) > 1"
    ),
    "primary_key": (
        "SELECT l_orderkey * 10 + l_linenumber AS key_1, count(*) AS row_count FROM lineitem "
        "GROUP BY l_orderkey * 10 + l_linenumber HAVING count(*) > 1"
    ),
    "reconcile": reconcile(),
    "source_profile": (
        f"SELECT trim(customer_id) AS customer_src_id, trim(customer_name) AS customer_name, trim(segment) AS customer_segment, "
        f"count(*) AS source_row_count FROM ({plain(sales_text('cash', ['customer_id', 'customer_name', 'segment']))}) AS c "
        "GROUP BY trim(customer_id), trim(customer_name), trim(segment)"
    ),
    "source_change": (
        "SELECT CASE WHEN trim(customer_id) = '7' THEN 'SCD2_TEST_SEGMENT' ELSE trim(segment) END AS customer_segment, "
        f"count(*) AS source_row_count FROM ({plain(sales_text('cash', ['customer_id', 'segment']))}) AS c GROUP BY 1"
    ),
    "leftover_rows": (
        "SELECT count(*) AS remaining_test_segment_rows FROM "
        f"({plain(sales_text('cash', ['customer_id', 'segment']))}) AS c "
        "WHERE trim(customer_id) = '7' AND trim(segment) = 'SCD2_TEST_SEGMENT'"
    ),
    "filtered_count": "SELECT count(*) AS row_count FROM orders WHERE o_orderstatus = 'F'",
    "row_count": (
        "SELECT 'cash' AS table_name, count(*) AS row_count FROM lineitem WHERE l_linestatus = 'F' UNION ALL "
        "SELECT 'card', count(*) FROM lineitem WHERE l_linestatus = 'O'"
    ),
    "conditional_update": (
        "SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END "
        "AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
    ),
    "conditional_delete": (
        f"SELECT payment_id, returned FROM ({plain(sales_text('card', ['payment_id', 'returned']))}) AS c "
        "WHERE returned IS DISTINCT FROM 'R'"
    ),
    "latest_log": (
        "SELECT log_id, log_datetime, procedure_name, target_table, rows_affected, status, message, error_code, error_message "
        "FROM (SELECT *, row_number() OVER (PARTITION BY procedure_name ORDER BY log_id DESC) AS rn "
        f"FROM ({plain(LOG_TEXT)}) AS l) AS ranked WHERE rn = 1"
    ),
    "top_log": (
        f"SELECT * FROM ({plain(LOG_TEXT)}) AS l WHERE procedure_name IN ('click', 'view') ORDER BY log_id DESC LIMIT 6"
    ),
    "warehouse_load": outcomes(rerun=False),
    "idempotent_rerun": outcomes(rerun=True),
    "idempotent_rerun_clean": " UNION ALL ".join(
        f"SELECT 'prc_load_dim_{name}' AS procedure_name, 'bl_dm.dim_{name}' AS target_table, CAST(0 AS BIGINT) AS rows_affected, "
        f"'SUCCESS' AS status, 'DIM_{name.upper()} loaded successfully.' AS message, CAST(NULL AS VARCHAR) AS error_code"
        for name in [*ENTITY, "time_day"]
    ),
    "loaded_rows": loaded(),
    "incremental_load": two_halves(),
    "survivor_state": survivor_states(),
    "scd2_rebuild": rebuilt(),
    "fact_load": facts(),
    "reconcile_buckets": reconcile(),
    "table_checks": table_checks(),
    "one_active_3nf": (
        f"WITH {FLAWED} SELECT trim(customer_src_id) AS key_1, count(*) AS row_count FROM flawed "
        "WHERE upper(trim(coalesce(is_active, ''))) = 'Y' GROUP BY trim(customer_src_id) HAVING count(*) > 1"
    ),
    "profile_merge": profile(),
    "quarantine_sales": quarantined(),
    "csv_scan_card": raw_text("card"),
    "table_life": (
        "WITH card AS (SELECT l_orderkey % 2 AS half FROM lineitem WHERE l_linestatus = 'O') "
        "SELECT 'created' AS step, CAST(1 AS BIGINT) AS row_count UNION ALL SELECT 'batch 1', count(*) FROM card WHERE half = 0 "
        "UNION ALL SELECT 'batch 2', count(*) FROM card UNION ALL SELECT 'truncated', 0 UNION ALL SELECT 'dropped', 0"
    ),
    "log_append": (
        "SELECT row_number() OVER (ORDER BY event_type) AS log_id, event_type AS procedure_name, count(*) AS rows_affected, "
        "'SUCCESS' AS status, true AS in_time FROM events GROUP BY event_type"
    ),
}
