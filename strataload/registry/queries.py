"""The registered queries: each runs one operator, or a few, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.functions.text import clean_text, fold_null, is_set
from strataload.operators import quality, scd2, upsert
from strataload.operators.dedup import maxima_state, merge_state, survivor_state, union_all, union_distinct
from strataload.operators.entity import PRIORITY, entity_default_row, new_entity_rows, ranked_rows, with_default
from strataload.operators.facts import fact_rows
from strataload.operators.keys import business_rows, literal_rows, number_rows
from strataload.operators.profile import batch_profile, merge_profiles
from strataload.operators.rows import (
    add_missing_columns,
    delete_where,
    empty_frame,
    number_pairs,
    update_where,
)
from strataload.plans import loads, validation
from strataload.plans.load_log import LOG_TABLE, write_log
from strataload.plans.specs import CUSTOMERS, DIMENSIONS, ENTITIES, load_rules
from strataload.registry.feed import AS_OF, Feed
from strataload.registry.texts import CALENDAR_TEXT, CUSTOMER_HISTORY_TEXT, FLAWED_TEXT
from strataload.session import materialize, scratch_path
from strataload.sources.csv import read_sales_csv, split_sales, stage_sales, write_sales_csv
from strataload.sources.schemas import CARD_COLUMNS, CASH_COLUMNS, ENTITY_SCHEMAS, FACT_SCHEMA
from strataload.sources.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Feed], DataFrame]):
        QUERIES[name] = lambda spark, directory: build(Feed(spark, directory))
        return build

    return register


# Sources, staging, layouts


@query("csv_scan")
def csv_scan(feed: Feed) -> DataFrame:
    path = scratch_path(feed.spark, "cash-csv")
    write_sales_csv(feed.raw("cash"), path)
    return read_sales_csv(feed.spark, path, CASH_COLUMNS)


@query("stage_cast_dedup")
def stage_cash(feed: Feed) -> DataFrame:
    return stage_sales(feed.raw("cash"))


@query("stage_card")
def stage_card(feed: Feed) -> DataFrame:
    return stage_sales(feed.raw("card"))


@query("limit_sample")
def limit_sample(feed: Feed) -> DataFrame:
    return stage_sales(feed.raw("cash")).orderBy("payment_id").limit(5)


@query("schema_evolve")
def schema_evolve(feed: Feed) -> DataFrame:
    """Rows stored before the source id existed, next to rows that carry it."""
    older = business_rows(feed.entity("products"), "product_id").drop("source_id")
    newer = feed.entity("products", "full").where("category = 'PROMO'")
    return add_missing_columns(older, {"source_id": T.StringType()}).unionByName(newer)


@query("range_generate")
def range_generate(feed: Feed) -> DataFrame:
    return number_pairs(feed.spark, feed.table("lineitem").count(), "bigint")


@query("generated_counts")
def generated_counts(feed: Feed) -> DataFrame:
    """Counts after a first insert and after a second, five times larger one."""
    n = feed.table("lineitem").count()
    first = number_pairs(feed.spark, n)
    both = first.unionByName(number_pairs(feed.spark, 5 * n))
    return quality.table_counts({"after_first_insert": first, "after_second_insert": both})


# Entity loads


def _delta(name: str, release: str) -> Callable[[Feed], DataFrame]:
    def build(feed: Feed) -> DataFrame:
        spec = ENTITIES[name]
        state = "prior_wide_key" if (name, release) == ("locations", "v2") else "prior"
        cash, card = feed.sources(spec)
        return new_entity_rows(spec, cash, card, feed.entity(name, state), AS_OF, load_rules(spec, release))

    return build


for _name in ENTITIES:
    for _release in ("v1", "v2", "v3"):
        if _name == CUSTOMERS.name and _release != "v1":
            continue  # version history, below
        _suffix = "" if _release == "v3" else f"_{_release}"
        query(f"{_name}_delta{_suffix}")(_delta(_name, _release))


@query("not_in_null_target")
def not_in_null_target(feed: Feed) -> DataFrame:
    """A NULL among the stored keys lets no row through."""
    spec = ENTITIES["products"]
    target = feed.entity("products").withColumn("product_src_id", F.nullif("product_src_id", F.lit("0")))
    cash, card = feed.sources(spec)
    return new_entity_rows(spec, cash, card, target, AS_OF, load_rules(spec, "v1"))


@query("default_rows")
def default_rows(feed: Feed) -> DataFrame:
    """The unknown member is added once, also when the load runs twice."""
    spec = ENTITIES["products"]
    schema = ENTITY_SCHEMAS[spec.table]
    rows = business_rows(feed.entity("products"), spec.id_column)
    once = with_default(rows, entity_default_row(spec, rows, schema, "MANUAL"))
    return with_default(once, entity_default_row(spec, once, schema, "MANUAL"))


@query("surrogate_keys")
def surrogate_keys(feed: Feed) -> DataFrame:
    """Every payment of both systems, numbered in text order above the order numbers."""
    payments = union_all([feed.sales(s, ["payment_id"], distinct=True) for s in ("cash", "card")]).distinct()
    top = feed.table("orders").agg(F.max("o_orderkey").alias("top")).scalar()
    return number_rows(payments, "payment_surr_id", ["payment_id"], top)


# Version history


def _changes(feed: Feed, target: DataFrame) -> DataFrame:
    return scd2.detect_changes(*feed.sources(CUSTOMERS), target)


def _customers_after(feed: Feed) -> DataFrame:
    target = feed.entity("customers_scd")
    return scd2.apply_changes(target, _changes(feed, target), AS_OF)


@query("scd2_changes")
def scd2_changes(feed: Feed) -> DataFrame:
    return _changes(feed, feed.entity("customers_scd"))


@query("scd2_preview")
def scd2_preview(feed: Feed) -> DataFrame:
    """What one source segment would change."""
    return _changes(feed, feed.entity("customers_scd")).where("customer_segment = 'BUILDING'")


@query("scd2_apply")
def scd2_apply(feed: Feed) -> DataFrame:
    return _customers_after(feed)


@query("scd2_accounting")
def scd2_accounting(feed: Feed) -> DataFrame:
    """Closed and opened versions; every changed key must close one."""
    target = feed.entity("customers_scd")
    changes = _changes(feed, target)
    closed = scd2.close_versions(target, changes, AS_OF).agg(F.count_if("_closed").alias("row_count"))
    opened = changes.agg(
        F.count("*").alias("opened_rows"), F.count_if(F.col("change_type") == scd2.CHANGED).alias("changed_keys")
    )
    return opened.select(
        "opened_rows",
        "changed_keys",
        closed.scalar().alias("closed_rows"),
        (F.col("opened_rows") + closed.scalar()).alias("rows_affected"),
    )


@query("scd2_v2_apply")
def scd2_v2_apply(feed: Feed) -> DataFrame:
    cash, card = feed.sources(CUSTOMERS)
    return scd2.apply_two_step(cash, card, feed.entity("customers_scd"), AS_OF)


@query("scd2_propagate")
def scd2_propagate(feed: Feed) -> DataFrame:
    target = feed.dimension("customers_scd")
    spec = DIMENSIONS["customers_scd"]
    changed = upsert.dimension_upserts(spec, _customers_after(feed), target, AS_OF)
    return upsert.apply_upserts(target, materialize(changed, "upserts"), spec.id_column)


@query("scd2_revert")
def scd2_revert(feed: Feed) -> DataFrame:
    """Undo the second versions of the flawed history and reopen the closed ones."""
    flawed = feed.sql(FLAWED_TEXT)
    return scd2.revert_version(flawed, F.col("customer_segment") == "SECOND", F.col("is_active") == "N")


@query("layer_history")
def layer_history(feed: Feed) -> DataFrame:
    return scd2.layer_history(feed.sql(FLAWED_TEXT), feed.dimension("customers_scd"))


@query("version_summary")
def version_summary(feed: Feed) -> DataFrame:
    return scd2.version_summary(scd2.layer_history(feed.sql(FLAWED_TEXT), feed.dimension("customers_scd")))


# Star schema


def _dim_upsert(name: str) -> Callable[[Feed], DataFrame]:
    def build(feed: Feed) -> DataFrame:
        spec = DIMENSIONS[name]
        target = feed.dimension(name)
        upserts = upsert.dimension_upserts(spec, feed.entity(name, "full"), target, AS_OF)
        return upsert.apply_upserts(target, materialize(upserts, "upserts"), spec.id_column)

    return build


for _name in DIMENSIONS:
    query(f"dim_upsert_{_name}")(_dim_upsert(_name))


@query("dim_product_rows")
def dim_product_rows(feed: Feed) -> DataFrame:
    rows = upsert.dimension_rows(DIMENSIONS["products"], feed.entity("products", "full"), AS_OF)
    return rows.orderBy("product_surr_id")


@query("dim_time_day")
def dim_time_day(feed: Feed) -> DataFrame:
    target = feed.sql(CALENDAR_TEXT)
    upserts = materialize(upsert.calendar_upserts(*feed.days(), target), "upserts")
    return upsert.apply_upserts(target, upserts, "date_surr_id")


# Checks


def _dimensions(feed: Feed) -> dict[str, tuple[DataFrame, str]]:
    tables = {f"dim_{name}": (feed.dimension(name), spec.id_column) for name, spec in DIMENSIONS.items()}
    return {**tables, "dim_time_day": (feed.sql(CALENDAR_TEXT), "date_surr_id")}


@query("dim_counts")
def dim_counts(feed: Feed) -> DataFrame:
    return quality.member_counts(_dimensions(feed)).orderBy("table_name")


@query("layer_counts")
def layer_counts(feed: Feed) -> DataFrame:
    tables = {f"ce_{name}": feed.entity(name) for name in ENTITIES}
    tables |= {name: df for name, (df, _) in _dimensions(feed).items()}
    tables["fct_sales_dd"] = empty_frame(feed.spark, FACT_SCHEMA)
    return quality.table_counts(tables).orderBy("table_name")


@query("dup_keys")
def dup_keys(feed: Feed) -> DataFrame:
    frames = {
        "product_src_id": business_rows(feed.entity("products", "full"), "product_id"),
        "customer_src_id": business_rows(feed.sql(FLAWED_TEXT), "customer_id").where("is_active = 'Y'"),
        "location_src_id": business_rows(feed.entity("locations", "full"), "location_id"),
    }
    found = [
        quality.duplicate_keys(df, key).select(F.lit(key).alias("key_name"), F.col(key).alias("key_value"), "row_count")
        for key, df in frames.items()
    ]
    return union_all(found)


@query("one_active")
def one_active(feed: Feed) -> DataFrame:
    entity = quality.not_exactly_one_active(feed.sql(FLAWED_TEXT), "customer_id")
    dimension = quality.not_exactly_one_active(feed.dimension("customers_scd"), "customer_surr_id")
    return union_all(
        [entity.withColumn("layer_name", F.lit("BL_3NF")), dimension.withColumn("layer_name", F.lit("BL_DM"))]
    )


@query("one_active_index")
def one_active_index(feed: Feed) -> DataFrame:
    condition = (F.col("customer_id") != -1) & is_set(F.col("is_active"))
    return quality.unique_violations(feed.sql(FLAWED_TEXT), [F.trim("customer_src_id")], condition)


@query("version_unique")
def version_unique(feed: Feed) -> DataFrame:
    keys = [F.trim("customer_src_id"), F.col("start_dt")]
    return quality.unique_violations(feed.sql(FLAWED_TEXT), keys, F.col("customer_id") != -1)


@query("key_unique")
def key_unique(feed: Feed) -> DataFrame:
    """Padded spellings and second names, checked against the rule for stored employees."""
    rows = union_distinct([feed.sales(s, ["employee_id", "employee_name"], distinct=True) for s in ("cash", "card")])
    return quality.unique_violations(rows, [F.trim("employee_id")])


@query("primary_key")
def primary_key(feed: Feed) -> DataFrame:
    """Line items carry repeated (order, line) numbers; orders do not."""
    lines = feed.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"))
    orders = feed.table("orders").select((-F.col("o_orderkey") - 1).alias("line_id"))
    return quality.key_violations(lines.unionByName(orders), "line_id")


_RECONCILED = [
    "customer_src_id", "customer_name", "customer_segment", "source_system", "source_entity",
    "start_dt", "end_dt", "is_active", "insert_dt",
]


@query("reconcile")
def reconcile(feed: Feed) -> DataFrame:
    entity = feed.entity("customers_scd", "full").select("customer_id", *_RECONCILED)
    dimension = feed.dimension("customers_scd").select("customer_surr_id", *_RECONCILED)
    return quality.reconcile(entity, dimension, "only_in_bl_3nf", "only_in_bl_dm")


@query("source_profile")
def source_profile(feed: Feed) -> DataFrame:
    names = {"customer_id": "customer_src_id", "customer_name": "customer_name", "segment": "customer_segment"}
    return quality.source_profile(feed.sales("cash", list(names)), names)


@query("source_change")
def source_change(feed: Feed) -> DataFrame:
    """A changed segment in the source, counted as the load would see it."""
    rows = feed.sales("cash", ["customer_id", "segment"])
    changed = update_where(rows, F.trim("customer_id") == "7", {"segment": F.lit("SCD2_TEST_SEGMENT")})
    return quality.source_profile(changed, {"segment": "customer_segment"})


@query("leftover_rows")
def leftover_rows(feed: Feed) -> DataFrame:
    condition = (F.trim("customer_id") == "7") & (F.trim("segment") == "SCD2_TEST_SEGMENT")
    return quality.matching_rows(feed.sales("cash", ["customer_id", "segment"]), condition, "remaining_test_segment_rows")


@query("filtered_count")
def filtered_count(feed: Feed) -> DataFrame:
    return quality.matching_rows(feed.table("orders"), F.col("o_orderstatus") == "F", "row_count")


@query("row_count")
def row_count(feed: Feed) -> DataFrame:
    return quality.table_counts({s: feed.sales(s, ["payment_id"]) for s in ("cash", "card")})


@query("conditional_update")
def conditional_update(feed: Feed) -> DataFrame:
    return update_where(feed.table("orders"), F.col("o_orderpriority") == "1-URGENT", {"o_orderstatus": F.lit("U")})


@query("conditional_delete")
def conditional_delete(feed: Feed) -> DataFrame:
    """Rows with a NULL condition stay."""
    return delete_where(feed.sales("card", ["payment_id", "returned"]), F.col("returned") == "R")


# Load log


@query("latest_log")
def latest_log(feed: Feed) -> DataFrame:
    return quality.latest_entries(feed.log)


@query("top_log")
def top_log(feed: Feed) -> DataFrame:
    chosen = feed.log.where(F.col("procedure_name").isin("click", "view"))
    return quality.newest_entries(chosen, 6)


def _loaded(feed: Feed) -> Warehouse:
    warehouse = Warehouse(feed.spark, scratch_path(feed.spark, "warehouse"))
    loads.load_staging(warehouse, feed.raw("cash"), feed.raw("card"))
    loads.load_all(warehouse, AS_OF)
    return warehouse


_OUTCOME = ["procedure_name", "target_table", "rows_affected", "status", "message", "error_code"]


@query("warehouse_load")
def warehouse_load(feed: Feed) -> DataFrame:
    """All layers loaded from nothing: what each load of an entity or dimension reports."""
    tables = [spec.table for spec in ENTITIES.values()] + list(loads.dimension_ids())
    return validation.load_outcomes(_loaded(feed), tables).select(*_OUTCOME)


@query("idempotent_rerun")
def idempotent_rerun(feed: Feed) -> DataFrame:
    """The dimension loads run again: all report success and no row, save those that failed before."""
    warehouse = _loaded(feed)
    affected = loads.load_dimensions(warehouse, AS_OF)
    return validation.load_outcomes(warehouse, list(affected)).select(*_OUTCOME)


@query("idempotent_rerun_clean")
def idempotent_rerun_clean(feed: Feed) -> DataFrame:
    """Rows without a flaw: all eight dimension loads run again report success and no row."""
    warehouse = Warehouse(feed.spark, scratch_path(feed.spark, "warehouse"))
    loads.load_staging(warehouse, feed.clean_raw("cash"), feed.clean_raw("card"))
    loads.load_all(warehouse, AS_OF)
    affected = loads.load_dimensions(warehouse, AS_OF)
    return validation.load_outcomes(warehouse, list(affected)).select(*_OUTCOME)


# Stored rows


def _stored(warehouse: Warehouse, table: str, id_column: str, key: str, attributes: list[str]) -> DataFrame:
    """Business rows of any entity or dimension under one layout."""
    rows = business_rows(warehouse.read(table), id_column)
    dated = "is_active" in rows.columns
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col(id_column).alias("row_id"),
        F.col(key).alias("business_key"),
        F.concat_ws("|", *attributes).alias("attributes"),
        *[(F.col(c) if dated else F.lit(None)).cast("date").alias(c) for c in ("start_dt", "end_dt")],
        (F.col("is_active") if dated else F.lit(None)).cast("string").alias("is_active"),
    )


def _all_stored(warehouse: Warehouse) -> DataFrame:
    frames = []
    for name, spec in ENTITIES.items():
        dimension = DIMENSIONS[name]
        frames.append(_stored(warehouse, spec.table, spec.id_column, spec.key, spec.attribute_names))
        frames.append(_stored(warehouse, dimension.table, dimension.id_column, spec.key, spec.attribute_names))
    return union_all(frames)


@query("loaded_rows")
def loaded_rows(feed: Feed) -> DataFrame:
    """What both layers hold of customers and products after a load, and the calendar, row by row."""
    warehouse = _loaded(feed)
    frames = []
    for name in ("products", CUSTOMERS.name):
        spec, dimension = ENTITIES[name], DIMENSIONS[name]
        frames.append(_stored(warehouse, spec.table, spec.id_column, spec.key, spec.attribute_names))
        frames.append(_stored(warehouse, dimension.table, dimension.id_column, spec.key, spec.attribute_names))
    days = ["day_of_week", "day_name", "month", "month_name", "quarter", "year", "is_weekend"]
    calendar = _stored(warehouse, loads.CALENDAR_TABLE, "date_surr_id", "date", days)
    return union_all([*frames, calendar.withColumn("business_key", F.col("business_key").cast("string"))])


@query("incremental_load")
def incremental_load(feed: Feed) -> DataFrame:
    """Both layers after a load of the even orders and, a day later, one of the odd ones, which reads only those."""
    warehouse = Warehouse(feed.spark, scratch_path(feed.spark, "warehouse"))
    for half in (0, 1):
        cash, card = (feed.clean_raw(s).where(F.col("order_id").cast("long") % 2 == half) for s in ("cash", "card"))
        loads.load_staging(warehouse, cash, card)
        loads.load_all(warehouse, AS_OF + dt.timedelta(days=half))
    return _all_stored(warehouse).drop("row_id")


@query("survivor_state")
def survivor_states(feed: Feed) -> DataFrame:
    """Survivors of products and customers, and maxima of employees, kept as state over three batches of orders."""
    shaped = []
    for name in ("products", CUSTOMERS.name, "employees"):
        spec = ENTITIES[name]
        rules = load_rules(spec, "v2" if name == "employees" else "v3")
        state = None
        for part in range(3):
            batch = F.col("order_id").cast("long") % 3 == part
            columns = [*spec.staging_columns, "order_id"]
            # The variants are made distinct with the state; with its order number, hardly a line occurs twice.
            cash, card = (feed.sales(s, columns).where(batch) for s in ("cash", "card"))
            if name == "employees":
                rows = union_all([cash, card]).select(F.col("employee_id").alias(spec.key), "employee_name")
                reduce_rows = partial(maxima_state, key=spec.key, attributes=spec.attribute_names)
            else:
                rows = ranked_rows(spec, cash, card, rules)
                reduce_rows = partial(
                    survivor_state, key=spec.key, priority=PRIORITY, attributes=spec.attribute_names
                )
            if state is None:
                state = materialize(reduce_rows(rows), "state")
                continue
            touched = materialize(merge_state(state, rows, [spec.key], reduce_rows), "touched")
            state = materialize(state.join(touched, spec.key, "left_anti").unionByName(touched), "state")
        shaped.append(
            state.select(
                F.lit(name).alias("entity_name"),
                F.col(spec.key).alias("business_key"),
                (F.col(PRIORITY) if PRIORITY in state.columns else F.lit(0)).cast("int").alias("priority"),
                F.concat_ws("|", *[fold_null(F.col(a)) for a in spec.attribute_names]).alias("attributes"),
            )
        )
    return union_all(shaped)


@query("scd2_rebuild")
def scd2_rebuild(feed: Feed) -> DataFrame:
    """Every customer's history from the dated names and segments of all sales, several of one day among them."""
    columns = [*CUSTOMERS.staging_columns, "order_date", "order_id"]
    sales = union_all([feed.sales(s, columns, distinct=True) for s in ("cash", "card")])
    events = sales.select(
        F.trim("customer_id").alias("customer_src_id"),
        clean_text(F.col("customer_name")).alias("customer_name"),
        clean_text(F.col("segment")).alias("customer_segment"),
        "order_date",
        F.col("order_id").cast("long").alias("order_id"),
    )
    return scd2.rebuild_versions(
        events, "customer_src_id", ["customer_name", "customer_segment"], "order_date", ["order_id"]
    )


@query("fact_load")
def fact_load(feed: Feed) -> DataFrame:
    """All sales as facts: customers by the version of the order date, missing members as -1."""
    members = {name: feed.dimension(name) for name in DIMENSIONS}
    members[CUSTOMERS.name] = feed.sql(CUSTOMER_HISTORY_TEXT)
    return fact_rows(feed.staged("cash"), feed.staged("card"), members, feed.sql(CALENDAR_TEXT), AS_OF)


# Checks in one scan, fingerprints, profiles, quarantine


@query("reconcile_buckets")
def reconcile_buckets(feed: Feed) -> DataFrame:
    entity = feed.entity("customers_scd", "full").select("customer_id", *_RECONCILED)
    dimension = feed.dimension("customers_scd").select("customer_surr_id", *_RECONCILED)
    return quality.reconcile_by_buckets(entity, dimension, "only_in_bl_3nf", "only_in_bl_dm")


@query("table_checks")
def table_checks(feed: Feed) -> DataFrame:
    """Counts and uniqueness rules of the flawed customer versions, from one write and one scan."""
    business = F.col("customer_id") != -1
    active = is_set(F.col("is_active"))
    key = F.trim("customer_src_id")
    rules = {
        "primary_key": ([F.col("customer_id")], None),
        "one_active_3nf": ([key], active),
        "one_active_dm": ([key], business & active),
        "one_version_per_day": ([key, F.col("start_dt")], business),
        "unique_key": ([key], business),
    }
    write = partial(materialize, label="checked")
    return quality.checked_while_written(feed.sql(FLAWED_TEXT), "customer_id", rules, write)


@query("one_active_3nf")
def one_active_3nf(feed: Feed) -> DataFrame:
    """The rule of the entity layer, which the unknown member is subject to as well."""
    return quality.unique_violations(feed.sql(FLAWED_TEXT), [F.trim("customer_src_id")], is_set(F.col("is_active")))


@query("profile_merge")
def profile_merge(feed: Feed) -> DataFrame:
    """Profiles of three batches of sales merged into one. The estimates are held against exact numbers."""
    columns = ["customer_id", "customer_name", "product_id", "postal_code", "sales", "quantity"]
    rows = materialize(feed.sales("cash", [*columns, "order_id"]), "profiled")
    batches = [rows.where(F.col("order_id").cast("long") % 3 == part) for part in range(3)]
    merged = merge_profiles([materialize(batch_profile(batch, columns), "profile") for batch in batches])
    exact = rows.agg(*[F.count_distinct(c).alias(f"d_{c}") for c in columns]).first()
    ranks = []
    for r in merged.where("median_estimate is not null").select("column_name", "median_estimate").collect():
        value = F.col(r["column_name"]).cast("double")
        ranks += [
            F.avg((value < r["median_estimate"]).cast("int")).alias(f"below_{r['column_name']}"),
            F.avg((value <= r["median_estimate"]).cast("int")).alias(f"upto_{r['column_name']}"),
        ]
    shares = rows.agg(*ranks).first().asDict()
    distinct = F.element_at(F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(exact[f"d_{c}"]))]), F.col("column_name"))
    close = F.abs(F.col("distinct_estimate") - distinct) <= F.greatest(F.lit(2.0), 0.06 * distinct)
    middle = F.lit(True)
    for c in ("sales", "quantity"):
        good = shares[f"below_{c}"] <= 0.55 and shares[f"upto_{c}"] >= 0.45
        middle = F.when(F.col("column_name") == c, F.lit(good)).otherwise(middle)
    return merged.select(
        "column_name", "row_count", "null_count", "blank_count", "smallest", "largest",
        close.alias("distinct_is_close"), middle.alias("median_is_close"),
    )


@query("quarantine_sales")
def quarantine_sales(feed: Feed) -> DataFrame:
    """Rows whose values do not fit their types, with the reasons; the others are loaded."""
    order = F.col("order_id").cast("long")
    raw = feed.raw("cash").withColumns(
        {
            "sales": F.when(order % 50 == 7, F.lit("n/a")).otherwise(F.col("sales")),
            "quantity": F.when(order % 70 == 7, F.concat("quantity", F.lit(" pieces"))).otherwise(F.col("quantity")),
        }
    )
    good, bad, counts = split_sales(raw)
    if counts["read"] != counts["typed"] + counts["rejected"]:
        raise AssertionError(counts)
    kept = good.select(F.lit("typed").alias("outcome"), "payment_id", F.col("sales").cast("string").alias("sales"))
    away = bad.select(F.concat_ws("; ", "reasons").alias("outcome"), "payment_id", "sales")
    return kept.unionByName(away)


@query("csv_scan_card")
def csv_scan_card(feed: Feed) -> DataFrame:
    path = scratch_path(feed.spark, "card-csv")
    write_sales_csv(feed.raw("card"), path)
    return read_sales_csv(feed.spark, path, CARD_COLUMNS)


@query("table_life")
def table_life(feed: Feed) -> DataFrame:
    """Rows of a staging table after two batches, after a truncate, and whether it is there after a drop."""
    warehouse = Warehouse(feed.spark, scratch_path(feed.spark, "warehouse"))
    steps = [("created", int(warehouse.create_if_absent(loads.CARD_TABLE)))]
    for half in (1, 2):
        warehouse.append_batch(loads.CARD_TABLE, feed.staged("card").where(F.col("order_id").cast("long") % 2 == half - 1), half)
        steps.append((f"batch {half}", warehouse.count(loads.CARD_TABLE)))
    warehouse.truncate(loads.CARD_TABLE)
    steps.append(("truncated", warehouse.count(loads.CARD_TABLE)))
    warehouse.drop_if_exists(loads.CARD_TABLE)
    steps.append(("dropped", int(warehouse.exists(loads.CARD_TABLE))))
    return literal_rows(feed.spark, steps, T.StructType().add("step", "string").add("row_count", "long"))


@query("log_append")
def log_append(feed: Feed) -> DataFrame:
    """One log entry per kind of event with its number of rows; numbers and times are assigned on the way."""
    warehouse = Warehouse(feed.spark, scratch_path(feed.spark, "warehouse"))
    began = feed.spark.sql("SELECT localtimestamp() AS t").first()["t"]
    kinds = feed.table("events").groupBy("event_type").count().orderBy("event_type").limit(100).collect()
    for kind in kinds:
        write_log(warehouse, kind["event_type"], "events", kind["count"], "SUCCESS", None)
    log = warehouse.read(LOG_TABLE)
    in_time = (F.col("log_datetime") >= F.lit(began)) & (F.col("log_datetime") <= F.localtimestamp())
    return log.select("log_id", "procedure_name", "rows_affected", "status", in_time.alias("in_time"))
