"""The load steps over a warehouse, and the order in which they run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.functions.dates import HIGH_DATE, LOW_DATE
from strataload.functions.text import UNKNOWN
from strataload.operators import quality, scd2, upsert
from strataload.operators.dedup import first_of_repeated, merge_state, survivor_state, union_all
from strataload.operators.entity import PRIORITY, count_by, entity_default_values, new_entity_rows, ranked_rows
from strataload.operators.facts import fact_rows
from strataload.operators.keys import DEFAULT_KEY, business_rows, has_default_row, single_row
from strataload.operators.rows import conform
from strataload.plans.load_log import MARK_TABLE, last_mark, run_step, write_marks
from strataload.plans.specs import (
    CALENDAR_ID,
    CALENDAR_TABLE,
    DIMENSIONS,
    ENTITIES,
    DimensionSpec,
    EntitySpec,
    LoadRules,
    Release,
    load_rules,
)
from strataload.session import materialize
from strataload.sources.csv import split_sales, typed_sales
from strataload.sources.schemas import TABLE_SCHEMAS
from strataload.sources.warehouse import Check, MissingTable, Warehouse

CASH_TABLE = "sa_cash_sales.src_cash_sales"
CARD_TABLE = "sa_card_sales.src_card_sales"
SURVIVOR_TABLE = "bl_cl.customer_survivors"
FACT_TABLE = "bl_dm.fct_sales_dd"
REJECTED_TABLE = "bl_cl.rejected_sales"
STAGING_STEP = "sa.staging"


def _side_by_side(warehouse: Warehouse, steps: Mapping[str, Callable[[], Any]], workers: int) -> dict[str, Any]:
    """Run independent loads from a few driver threads, so that small jobs do not wait for each other."""
    with ThreadPoolExecutor(workers) as pool:
        running = {
            table: pool.submit(inheritable_thread_target(warehouse.spark)(step)) for table, step in steps.items()
        }
        return {table: future.result() for table, future in running.items()}


def create_tables(warehouse: Warehouse) -> None:
    """Every table of every layer, if absent, and the unknown members of the star schema."""
    for table in TABLE_SCHEMAS:
        warehouse.create_if_absent(table)
    add_star_defaults(warehouse)


def star_default_values(table: str, id_column: str) -> dict[str, Any]:
    """The unknown member of a dimension. Numbers of the unknown day are 0."""
    fill = {"string": UNKNOWN, "integer": 0, "date": LOW_DATE}
    values = {f.name: fill.get(f.dataType.typeName()) for f in TABLE_SCHEMAS[table].fields}
    values[id_column] = DEFAULT_KEY
    if "is_active" in values:
        values |= {"end_dt": HIGH_DATE, "is_active": "Y"}
    return values


def dimension_ids() -> dict[str, str]:
    return {**{spec.table: spec.id_column for spec in DIMENSIONS.values()}, CALENDAR_TABLE: CALENDAR_ID}


def add_star_defaults(warehouse: Warehouse, workers: int = 4) -> None:
    def add(table: str, id_column: str) -> int:
        if has_default_row(warehouse.read(table), id_column):
            return 0
        row = single_row(warehouse.spark, TABLE_SCHEMAS[table], star_default_values(table, id_column))
        warehouse.append(table, row)
        return 1

    _side_by_side(warehouse, {t: partial(add, t, i) for t, i in dimension_ids().items()}, workers)


def load_staging(
    warehouse: Warehouse,
    raw_cash: DataFrame,
    raw_card: DataFrame,
    date_format: str | None = None,
    quarantine: bool = False,
    raise_on_error: bool = True,
) -> int | None:
    """Add the typed, deduplicated rows of both source systems as one batch; returns the rows added.

    One logged step: both files are typed before either is added, so a bad file leaves both tables as they were. With
    ``quarantine``, rows with a value that does not fit are set aside with their reasons, and the others are loaded.
    The files are worked on side by side, so that the last tasks of one do not leave cores without work.
    """

    def typed_rows(table: str, raw: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
        bad_rows = []
        if quarantine:
            good, bad, counts = split_sales(raw, date_format)
            if counts["rejected"]:
                bad_rows.append(_rejected_rows(table, bad))
        else:
            good = materialize(typed_sales(raw, date_format), "typed")
        return first_of_repeated(good, ["payment_id"]), bad_rows

    def step() -> int:
        raws = {CASH_TABLE: raw_cash, CARD_TABLE: raw_card}
        typed = _side_by_side(warehouse, {t: partial(typed_rows, t, raw) for t, raw in raws.items()}, len(raws))
        batch = 1 + warehouse.last_batch(*typed)
        rejected = [bad for _, bad_rows in typed.values() for bad in bad_rows]
        if rejected:
            warehouse.append(REJECTED_TABLE, union_all(rejected).withColumn("batch", F.lit(batch).cast("long")))
        adding = {table: partial(warehouse.append_batch, table, rows, batch) for table, (rows, _) in typed.items()}
        return sum(_side_by_side(warehouse, adding, len(adding)).values())

    return run_step(warehouse, STAGING_STEP, step, raise_on_error)


def _rejected_rows(table: str, bad: DataFrame) -> DataFrame:
    """Rows of either file under one layout: the text of the row as JSON, and its reasons."""
    text = F.to_json(F.struct(*[c for c in bad.columns if c != "reasons"]))
    return bad.select(F.lit(table).alias("source_table"), text.alias("row_text"), "reasons")


def forget_progress(warehouse: Warehouse) -> None:
    """Let the next loads read all staging batches again, as after a correction of staged rows."""
    warehouse.truncate(SURVIVOR_TABLE)
    if warehouse.exists(MARK_TABLE):
        write_marks(warehouse, [*[spec.table for spec in ENTITIES.values()], CALENDAR_TABLE, FACT_TABLE], 0)


def _since(warehouse: Warehouse, batch: int) -> tuple[DataFrame, DataFrame]:
    """Staging rows of the batches after ``batch``, of both systems."""
    return warehouse.read_after(CASH_TABLE, batch), warehouse.read_after(CARD_TABLE, batch)


def _from_new_batches(warehouse: Warehouse, table: str, load: Callable[[int], int]) -> int:
    """Run a load over the staging batches its table has not seen, and note how far it came.

    ``load`` gets the last batch seen. Without newer ones no staging row is read. The note is written after the
    table: a load that dies in between sees the batch again, and finds nothing new in it.
    """
    for source in (CASH_TABLE, CARD_TABLE):
        if not warehouse.exists(source):
            raise MissingTable(source)
    seen, newest = last_mark(warehouse, table), warehouse.last_batch(CASH_TABLE, CARD_TABLE)
    if seen and seen == newest:
        return 0
    affected = load(seen)
    if newest > seen:
        write_marks(warehouse, [table], newest)
    return affected


def load_entity(
    warehouse: Warehouse,
    spec: EntitySpec,
    as_of: dt.date,
    release: Release = "v3",
    raise_on_error: bool = False,
    rebuild: bool = False,
) -> int | None:
    """Bring one entity up to date with the staging tables; returns the rows affected.

    ``v3`` reads the batches that are new since its last load; the older releases read all. ``rebuild`` builds the
    history of changed keys again, so that a second change on one day, or a late one, gives valid versions.
    """
    if release == "v3":
        load = partial(_load_versioned, rebuild=rebuild) if spec.versioned else _load_insert_only
        step = partial(_from_new_batches, warehouse, spec.table, partial(load, warehouse, spec, as_of))
    elif spec.versioned and release == "v2":
        step = partial(_load_two_step, warehouse, spec, as_of)
    else:
        step = partial(_load_insert_only, warehouse, spec, as_of, 0, release)
    return run_step(warehouse, spec.table, step, raise_on_error)


def _target(warehouse: Warehouse, spec: EntitySpec, rules: LoadRules) -> tuple[DataFrame, list[DataFrame]]:
    """The entity as the load sees it, and the unknown member in a list if it is yet to be stored."""
    stored = warehouse.read_or_empty(spec.table)
    if has_default_row(stored, spec.id_column):
        return stored, []
    values = entity_default_values(spec, rules.default_lineage)
    default = single_row(warehouse.spark, TABLE_SCHEMAS[spec.table], values)
    return stored.unionByName(default), [default]


def _load_insert_only(
    warehouse: Warehouse, spec: EntitySpec, as_of: dt.date, seen: int, release: Release = "v3"
) -> int:
    rules = load_rules(spec, release)
    target, default = _target(warehouse, spec, rules)
    # A key that is not stored yet has all its rows in the new batches.
    fresh = new_entity_rows(spec, *_since(warehouse, seen), target, as_of, rules)
    affected = fresh.count() + len(default)
    if affected:
        # Ids above the current maximum cannot collide; ids counted from 1 can, with any stored row.
        rows = union_all([conform(fresh, TABLE_SCHEMAS[spec.table]), *default])
        if not rules.continue_ids:
            quality.primary_key_check(spec.id_column)(warehouse.read_or_empty(spec.table).unionByName(rows))
        warehouse.append(spec.table, rows)
    return affected


def _load_versioned(
    warehouse: Warehouse, spec: EntitySpec, as_of: dt.date, seen: int, rebuild: bool = False
) -> int:
    rules = load_rules(spec, "v3")
    target, default = _target(warehouse, spec, rules)
    survivors = _survivors(warehouse, spec, seen, rules)
    changes = scd2.changes_of(survivors, target, spec)
    counts = count_by(changes, "change_type", [scd2.NEW, scd2.CHANGED])
    # A change closes one row and opens one.
    affected = 2 * counts[scd2.CHANGED] + counts[scd2.NEW] + len(default)
    if affected == 0:
        return 0
    checks = [quality.one_active_check(spec.key, spec.id_column)]
    if rebuild and counts[scd2.CHANGED]:
        return _rebuild_history(warehouse, spec, target, changes, as_of, default, checks)
    opened = union_all([scd2.opened_versions(changes, as_of, spec), *default])
    if counts[scd2.CHANGED] == 0:
        warehouse.append(spec.table, opened, checks)
        return affected
    closed = materialize(scd2.closed_versions(target, changes, as_of, spec), "closed")
    scd2.require_one_closed(closed, changes, spec)
    warehouse.merge(spec.table, opened.unionByName(closed), checks)
    return affected


def _rebuild_history(
    warehouse: Warehouse,
    spec: EntitySpec,
    target: DataFrame,
    changes: DataFrame,
    as_of: dt.date,
    default: list[DataFrame],
    checks: list[Check],
) -> int:
    versions = materialize(
        conform(scd2.corrected_versions(target, changes, as_of, spec), TABLE_SCHEMAS[spec.table]), "versions"
    )
    keys = versions.select(F.col(spec.key).alias("_key")).distinct()
    stored = target.join(keys, F.trim(spec.key) == F.col("_key"), "left_semi")
    # A state that no longer differs from the one before it has no version of its own.
    gone = materialize(stored.select(spec.id_column).join(versions, spec.id_column, "left_anti"), "gone")
    changed = materialize(union_all([versions.exceptAll(stored.select(*versions.columns)), *default]), "changed")
    unique = quality.version_check(spec.key, spec.id_column)
    warehouse.merge(spec.table, changed, [*checks, unique], deleted=gone)
    return changed.count() + gone.count()


def _survivors(warehouse: Warehouse, spec: EntitySpec, seen: int, rules: LoadRules) -> DataFrame:
    """Survivors over all batches of the keys that the new batches mention; their state is kept for the next load."""
    ranked = ranked_rows(spec, *_since(warehouse, seen), rules)
    warehouse.create_if_absent(SURVIVOR_TABLE)
    state = merge_state(
        warehouse.read(SURVIVOR_TABLE),
        ranked,
        [spec.key],
        lambda rows: survivor_state(rows, spec.key, PRIORITY, spec.attribute_names),
    )
    state = materialize(state, "survivors")
    warehouse.merge(SURVIVOR_TABLE, state)
    return state.drop(PRIORITY)


def _load_two_step(warehouse: Warehouse, spec: EntitySpec, as_of: dt.date) -> int:
    target, default = _target(warehouse, spec, load_rules(spec, "v2"))
    state = scd2.apply_two_step(*_since(warehouse, 0), target, as_of, spec)
    before = target.select(spec.id_column, F.col("is_active").alias("_before"))
    # Opened rows are not stored yet, closed ones were active.
    changed = state.join(before, spec.id_column, "left").where(
        F.col("_before").isNull() | ((F.col("_before") == "Y") & (F.col("is_active") == "N"))
    )
    changed = materialize(changed.drop("_before"), "two_step")
    affected = changed.count() + len(default)
    if affected:
        warehouse.merge(spec.table, union_all([conform(changed, TABLE_SCHEMAS[spec.table]), *default]))
    return affected


def _dimension_checks(spec: DimensionSpec) -> list[Check]:
    key, id_column = spec.entity.key, spec.id_column
    if spec.entity.versioned:
        return [quality.one_active_check(key, id_column), quality.version_check(key, id_column)]
    # Several postal codes share one location key, so locations have no unique key.
    return [] if spec.entity.name == "locations" else [quality.unique_text_check(key, id_column)]


def _publish_upserts(
    warehouse: Warehouse,
    table: str,
    id_column: str,
    upserts: DataFrame,
    checks: list[Check],
    gone: DataFrame | None = None,
) -> int:
    rows = materialize(upserts, "upserts")
    counts = count_by(rows, upsert.ACTION, [upsert.INSERT, upsert.UPDATE])
    dropped = gone.count() if gone is not None else 0
    affected = sum(counts.values()) + dropped
    if affected == 0:
        return 0
    quality.primary_key_check(id_column)(rows)
    if counts[upsert.UPDATE] + dropped == 0:
        warehouse.append(table, rows.drop(upsert.ACTION), checks)
    else:
        warehouse.merge(table, rows.drop(upsert.ACTION), checks, deleted=gone if dropped else None)
    return affected


def load_dimension(
    warehouse: Warehouse, spec: DimensionSpec, as_of: dt.date, raise_on_error: bool = False
) -> int | None:
    """Bring one dimension up to date with its entity; returns the rows affected."""

    def step() -> int:
        target = warehouse.read_or_empty(spec.table)
        entity = warehouse.read(spec.entity.table)
        upserts = upsert.dimension_upserts(spec, entity, target, as_of)
        gone = None
        if spec.entity.versioned:
            # A rebuilt history can have fewer versions than before.
            ids = entity.select(F.col(spec.entity.id_column).alias(spec.id_column))
            kept = business_rows(target, spec.id_column).select(spec.id_column)
            gone = materialize(kept.join(ids, spec.id_column, "left_anti"), "gone")
        return _publish_upserts(warehouse, spec.table, spec.id_column, upserts, _dimension_checks(spec), gone)

    return run_step(warehouse, spec.table, step, raise_on_error)


def load_calendar(warehouse: Warehouse, raise_on_error: bool = False) -> int | None:
    """Add the days that new staging batches mention."""

    def load(seen: int) -> int:
        target = warehouse.read_or_empty(CALENDAR_TABLE)
        upserts = upsert.calendar_upserts(*_since(warehouse, seen), target)
        checks = [quality.unique_column_check("date", CALENDAR_ID)]
        return _publish_upserts(warehouse, CALENDAR_TABLE, CALENDAR_ID, upserts, checks)

    step = partial(_from_new_batches, warehouse, CALENDAR_TABLE, load)
    return run_step(warehouse, CALENDAR_TABLE, step, raise_on_error)


def load_facts(warehouse: Warehouse, as_of: dt.date, raise_on_error: bool = False) -> int | None:
    """Add the sales of new staging batches as facts, against the dimensions as they stand.

    Facts lie in one folder per batch. A load that died before it was noted writes the folders of its batches again.
    """

    def load(seen: int) -> int:
        cash, card = (warehouse.read_after(t, seen, with_batch=True) for t in (CASH_TABLE, CARD_TABLE))
        members = {name: warehouse.read(spec.table) for name, spec in DIMENSIONS.items()}
        rows = materialize(fact_rows(cash, card, members, warehouse.read(CALENDAR_TABLE), as_of), "facts")
        warehouse.write_batches(FACT_TABLE, rows)
        return rows.count()

    step = partial(_from_new_batches, warehouse, FACT_TABLE, load)
    return run_step(warehouse, FACT_TABLE, step, raise_on_error)


def load_entities(
    warehouse: Warehouse, as_of: dt.date, release: Release = "v3", workers: int = 4
) -> dict[str, int | None]:
    """All entities; each depends on the staging tables only."""
    steps = {spec.table: partial(load_entity, warehouse, spec, as_of, release) for spec in ENTITIES.values()}
    return _side_by_side(warehouse, steps, workers)


def load_dimensions(warehouse: Warehouse, as_of: dt.date, workers: int = 4) -> dict[str, int | None]:
    """All dimensions; each depends on its entity, the calendar on the staging tables."""
    steps: dict[str, Callable[[], int | None]] = {
        spec.table: partial(load_dimension, warehouse, spec, as_of) for spec in DIMENSIONS.values()
    }
    steps[CALENDAR_TABLE] = partial(load_calendar, warehouse)
    return _side_by_side(warehouse, steps, workers)


def load_all(warehouse: Warehouse, as_of: dt.date, workers: int = 8) -> dict[str, int | None]:
    """Entities and the star schema, from staging tables that are already loaded.

    A dimension waits for its own entity alone; the calendar depends on the staging tables.
    """
    create_tables(warehouse)

    def both(name: str) -> tuple[int | None, int | None]:
        entity = load_entity(warehouse, ENTITIES[name], as_of)
        return entity, load_dimension(warehouse, DIMENSIONS[name], as_of)

    # The largest come first.
    steps: dict[str, Callable[[], Any]] = {name: partial(both, name) for name in reversed(ENTITIES)}
    steps[CALENDAR_TABLE] = partial(load_calendar, warehouse)
    loaded = _side_by_side(warehouse, steps, workers)
    entities = {spec.table: loaded[name][0] for name, spec in ENTITIES.items()}
    dimensions = {spec.table: loaded[name][1] for name, spec in DIMENSIONS.items()}
    return {**entities, **dimensions, CALENDAR_TABLE: loaded[CALENDAR_TABLE]}
