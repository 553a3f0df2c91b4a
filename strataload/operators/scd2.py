"""Version history: detect, close, open, propagate, revert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.functions.compare import any_changed_folded, any_distinct
from strataload.functions.dates import HIGH_DATE
from strataload.functions.text import clean_text, fold_null, is_set
from strataload.operators.entity import entity_columns, source_rows, source_systems
from strataload.operators.keys import DEFAULT_KEY, business_rows, current_max_key, number_rows
from strataload.operators.matching import rows_without_match
from strataload.operators.rows import delete_where, update_where
from strataload.plans.specs import CUSTOMERS, EntitySpec, load_rules
from strataload.session import materialize

NEW, CHANGED = "NEW", "CHANGED"


class CloseMismatch(RuntimeError):
    """The changed keys did not each close exactly one version."""

    sqlstate = "P0001"


def detect_changes(
    cash: DataFrame,
    card: DataFrame,
    target: DataFrame,
    spec: EntitySpec = CUSTOMERS,
    match_default_row: bool = False,
) -> DataFrame:
    """One row per key that is new or differs from its active version.

    The unknown member takes no part unless ``match_default_row`` is set; with it, a source key that
    reads like the unknown member closes that row.
    """
    source = source_rows(spec, cash, card, load_rules(spec, "v3"))
    return changes_of(source, target, spec, match_default_row)


def changes_of(
    source: DataFrame, target: DataFrame, spec: EntitySpec = CUSTOMERS, match_default_row: bool = False
) -> DataFrame:
    """The same from survivors, one row per key."""
    rules = load_rules(spec, "v3")
    active = target if match_default_row else business_rows(target, spec.id_column)
    active = active.where(is_set(F.col("is_active"))).select(
        F.col(spec.id_column).alias("_current"),
        F.trim(spec.key).alias("_key"),
        *[clean_text(F.col(a)).alias(f"_{a}") for a in spec.attribute_names],
    )
    differs = any_distinct([(F.col(a), F.col(f"_{a}")) for a in spec.attribute_names])
    changes = (
        source.join(active, source[spec.key] == active["_key"], "left")
        .where(F.col("_current").isNull() | differs)
        .select(
            F.when(F.col("_current").isNull(), F.lit(NEW)).otherwise(F.lit(CHANGED)).alias("change_type"),
            F.col("_current").alias(f"current_{spec.id_column}"),
            spec.key,
            *spec.attribute_names,
        )
    )
    new_id = f"new_{spec.id_column}"
    system, entity = source_systems(spec, rules)
    base = current_max_key(target, spec.id_column)
    return number_rows(changes, new_id, [spec.key, "change_type"], base).select(
        "change_type",
        f"current_{spec.id_column}",
        new_id,
        spec.key,
        *spec.attribute_names,
        F.lit(system).alias("source_system"),
        F.lit(entity).alias("source_entity"),
    )


def opened_versions(changes: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS) -> DataFrame:
    """The new active version of every change. It has no source id."""
    return changes.select(
        F.col(f"new_{spec.id_column}").alias(spec.id_column),
        spec.key,
        *spec.attribute_names,
        "source_system",
        "source_entity",
        F.lit(None).cast("string").alias("source_id"),
        F.lit(as_of).alias("start_dt"),
        F.lit(HIGH_DATE).alias("end_dt"),
        F.lit("Y").alias("is_active"),
        F.lit(as_of).alias("insert_dt"),
    )


def closed_versions(
    target: DataFrame, changes: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS
) -> DataFrame:
    """Only the rows that changes close, ended the day before."""
    superseded = changes.where(F.col("change_type") == CHANGED).select(
        F.col(f"current_{spec.id_column}").alias(spec.id_column)
    )
    active = target.where(is_set(F.col("is_active")))
    return _end_version(active.join(superseded, spec.id_column, "left_semi"), F.lit(True), as_of)


def require_one_closed(closed: DataFrame, changes: DataFrame, spec: EntitySpec = CUSTOMERS) -> None:
    """Every changed key closes exactly one version, else an error that names a key."""
    expected = changes.where(F.col("change_type") == CHANGED).select(F.trim(spec.key).alias("key"), F.lit(0).alias("n"))
    counted = expected.union(closed.select(F.trim(spec.key), F.lit(1))).groupBy("key").agg(F.sum("n").alias("closed"))
    wrong = counted.where("closed <> 1").first()
    if wrong is not None:
        raise CloseMismatch(f"changed key {wrong['key']!r} closes {wrong['closed']} versions")


def close_versions(
    target: DataFrame, changes: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS, flag: str = "_closed"
) -> DataFrame:
    """Stored rows with the superseded versions ended the day before; ``flag`` marks those."""
    superseded = changes.where(F.col("change_type") == CHANGED).select(
        F.col(f"current_{spec.id_column}").alias("_superseded")
    )
    joined = target.join(superseded, target[spec.id_column] == superseded["_superseded"], "left")
    marked = joined.withColumn(flag, F.col("_superseded").isNotNull() & is_set(F.col("is_active")))
    return _end_version(marked, F.col(flag), as_of).select(*target.columns, flag)


def _end_version(df: DataFrame, condition: Column, as_of: dt.date) -> DataFrame:
    return update_where(df, condition, {"end_dt": F.date_sub(F.lit(as_of), 1), "is_active": F.lit("N")})


def apply_changes(target: DataFrame, changes: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS) -> DataFrame:
    """State of the entity after all changes: kept, closed and opened rows."""
    stored = close_versions(target, changes, as_of, spec).drop("_closed")
    return stored.unionByName(opened_versions(changes, as_of, spec), allowMissingColumns=True)


def apply_two_step(
    cash: DataFrame, card: DataFrame, target: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS
) -> DataFrame:
    """The older load: close changed versions, then insert what has no equal active version.

    Survivors are the maxima per column, keys are compared untrimmed, and a NULL key reads as the
    unknown text. Both steps read the same source rows, which are therefore written once.
    """
    rules = load_rules(spec, "v2")
    source = materialize(source_rows(spec, cash, card, rules), "survivors")
    incoming = source.select(
        F.col(spec.key).alias("_key"), *[F.col(a).alias(f"_{a}") for a in spec.attribute_names]
    )
    pairs = [(F.col(a), F.col(f"_{a}")) for a in spec.attribute_names]
    open_rows = (F.col("is_active") == "Y") & (F.col(spec.id_column) != DEFAULT_KEY)
    changed = F.col("_key").isNotNull() & open_rows & any_changed_folded(pairs)
    joined = target.join(incoming, target[spec.key] == incoming["_key"], "left")
    closed = _end_version(joined, changed, as_of).select(*target.columns)

    active = target.where(F.col("is_active") == "Y")
    match = [(spec.key, F.col(spec.key)), *[(a, fold_null(F.col(a))) for a in spec.attribute_names]]
    fresh = number_rows(
        rows_without_match(source, active, match), spec.id_column, [spec.key], current_max_key(target, spec.id_column)
    )
    system, entity = source_systems(spec, rules)
    opened = fresh.select(
        spec.id_column,
        spec.key,
        *spec.attribute_names,
        F.lit(system).alias("source_system"),
        F.lit(entity).alias("source_entity"),
        F.col(spec.key).alias("source_id"),
        F.lit(as_of).alias("start_dt"),
        F.lit(HIGH_DATE).alias("end_dt"),
        F.lit("Y").alias("is_active"),
        F.lit(as_of).alias("insert_dt"),
    )
    return closed.unionByName(opened.select(*entity_columns(spec, rules)), allowMissingColumns=True)


def rebuild_versions(
    events: DataFrame, key: str, attributes: Sequence[str], day: str, order: Sequence[str] = ()
) -> DataFrame:
    """Version history of every key from its dated states, in whatever order they came.

    Of several states of one day the last by ``order`` counts (then the largest by attributes, so that the result does
    not depend on arrival). A state equal to the one before opens no version. A version ends the day before the next
    one starts; the last is active. Versions of a key therefore never overlap and leave no gap.
    Only rows that differ are sorted: repeated states of one day meet in an aggregate that starts on the map side.
    """
    states = events.select(key, day, *order, *attributes).distinct()
    latest = [F.col(c).desc_nulls_last() for c in [*order, *attributes]]
    of_day = Window.partitionBy(key, day).orderBy(*latest)
    last = states.withColumn("_rank", F.row_number().over(of_day)).where("_rank = 1").drop("_rank")
    by_day = Window.partitionBy(key).orderBy(day)
    state, first = F.struct(*attributes), F.row_number().over(by_day) == 1
    starts = last.withColumn("_new", first | ~state.eqNullSafe(F.lag(state).over(by_day))).where("_new")
    until = F.date_sub(F.lead(day).over(by_day), 1)
    return starts.select(
        key,
        *attributes,
        F.col(day).alias("start_dt"),
        F.coalesce(until, F.lit(HIGH_DATE)).alias("end_dt"),
        F.when(until.isNull(), F.lit("Y")).otherwise(F.lit("N")).alias("is_active"),
    )


def corrected_versions(
    target: DataFrame, changes: DataFrame, as_of: dt.date, spec: EntitySpec = CUSTOMERS
) -> DataFrame:
    """All versions of the changed keys after changes on any day, also a second one on a day or a late one.

    The stored versions of those keys and the changes are the states from which history is built again. A version
    keeps the id of the stored one that started on its day, and gets the change's new id otherwise.
    """
    changed = changes.select(
        F.trim(spec.key).alias("_key"),
        *spec.attribute_names,
        F.lit(as_of).alias("start_dt"),
        F.lit(1).alias("_turn"),
        F.col(f"new_{spec.id_column}").alias("_new_id"),
        "source_system",
        "source_entity",
    )
    keys = changed.select("_key").distinct()
    stored = business_rows(target, spec.id_column).withColumn("_key", F.trim(spec.key)).join(keys, "_key", "left_semi")
    events = stored.select("_key", *spec.attribute_names, "start_dt", F.lit(0).alias("_turn")).unionByName(
        changed.select("_key", *spec.attribute_names, "start_dt", "_turn")
    )
    versions = rebuild_versions(events, "_key", spec.attribute_names, "start_dt", ["_turn"])
    kept = stored.groupBy("_key", "start_dt").agg(
        F.min_by(F.struct(spec.id_column, "source_system", "source_entity", "source_id", "insert_dt"), spec.id_column).alias("_old")
    )
    fresh = changed.groupBy("_key", "start_dt").agg(
        F.min_by(F.struct("_new_id", "source_system", "source_entity"), "_new_id").alias("_fresh")
    )
    joined = versions.join(kept, ["_key", "start_dt"], "left").join(fresh, ["_key", "start_dt"], "left")
    return joined.select(
        F.coalesce(f"_old.{spec.id_column}", "_fresh._new_id").alias(spec.id_column),
        F.col("_key").alias(spec.key),
        *spec.attribute_names,
        F.coalesce("_fresh.source_system", "_old.source_system").alias("source_system"),
        F.coalesce("_fresh.source_entity", "_old.source_entity").alias("source_entity"),
        F.col("_old.source_id").alias("source_id"),
        "start_dt",
        "end_dt",
        "is_active",
        F.coalesce("_old.insert_dt", F.lit(as_of)).alias("insert_dt"),
    )


def revert_version(df: DataFrame, unwanted: Column, reopened: Column) -> DataFrame:
    """Delete the unwanted version and make the earlier one current again."""
    return update_where(
        delete_where(df, unwanted), reopened, {"end_dt": F.lit(HIGH_DATE), "is_active": F.lit("Y")}
    )


HISTORY_COLUMNS = ["customer_src_id", "customer_name", "customer_segment", "start_dt", "end_dt", "is_active"]


def layer_history(entity: DataFrame, dimension: DataFrame) -> DataFrame:
    """Versions of both layers under one layout; filter it for one customer."""

    def labelled(df: DataFrame, layer: str, id_column: str) -> DataFrame:
        return df.select(F.lit(layer).alias("layer_name"), F.col(id_column).alias("version_id"), *HISTORY_COLUMNS)

    return labelled(entity, "BL_3NF", "customer_id").unionByName(
        labelled(dimension, "BL_DM", "customer_surr_id")
    )


def version_summary(history: DataFrame) -> DataFrame:
    """Total, active and inactive versions per layer."""
    return history.groupBy("layer_name").agg(
        F.count("*").alias("total_versions"),
        F.count_if(F.upper(F.trim("is_active")) == "Y").alias("active_versions"),
        F.count_if(F.upper(F.trim("is_active")) == "N").alias("inactive_versions"),
    )
