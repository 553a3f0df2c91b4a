"""New rows for a normalised entity: sources → cleanse → one row per key → not stored yet → numbered."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.functions.dates import HIGH_DATE, LOW_DATE
from strataload.functions.text import UNKNOWN, clean_text, fold_null, has_key, joined_key, plain_concat_key
from strataload.operators.dedup import survivor_by_max, survivor_by_priority, union_all, union_distinct
from strataload.operators.keys import DEFAULT_KEY, business_rows, current_max_key, missing_default_row, number_rows
from strataload.operators.matching import rows_not_in, rows_without_match
from strataload.plans.specs import CARD_ENTITY, CARD_SYSTEM, CASH_ENTITY, CASH_SYSTEM, EntitySpec, LoadRules

PRIORITY = "priority"


def source_systems(spec: EntitySpec, rules: LoadRules) -> tuple[str, str]:
    """(source_system, source_entity) labels of a loaded row."""
    if spec.card_only:
        return CARD_SYSTEM, CARD_ENTITY
    if rules.both_labels:
        return f"{CASH_SYSTEM}/{CARD_SYSTEM}", f"{CASH_ENTITY}/{CARD_ENTITY}"
    return CASH_SYSTEM, CASH_ENTITY


def entity_sources(spec: EntitySpec, cash: DataFrame, card: DataFrame) -> list[DataFrame]:
    """The needed columns of each source system, cash first."""
    frames = [card] if spec.card_only else [cash, card]
    return [frame.select(*spec.staging_columns) for frame in frames]


def _key_column(spec: EntitySpec, rules: LoadRules) -> Column:
    """Business key over cleansed staging columns."""
    parts = [F.col(part) for part in spec.key_parts]
    if len(parts) == 1:
        return parts[0]
    if rules.keys == "raw":
        return plain_concat_key("_", *parts)
    return joined_key(rules.key_separator, *[F.col(c) for c in rules.joined_columns or spec.key_parts])


def _cleansed(spec: EntitySpec, frame: DataFrame, rules: LoadRules) -> DataFrame:
    """The staging columns of the entity, each once, cleansed as the rules say."""
    if rules.keys == "raw":
        return frame
    if rules.keys == "folded":
        return frame.select(*[fold_null(F.col(c)).alias(c) for c in spec.staging_columns])
    keyed = frame.where(reduce(and_, [has_key(F.col(part)) for part in spec.key_parts]))
    return keyed.select(
        *[(F.trim(c) if c in spec.key_parts else clean_text(F.col(c))).alias(c) for c in spec.staging_columns]
    )


def _stored_names(spec: EntitySpec, rows: DataFrame, rules: LoadRules) -> DataFrame:
    attributes = [F.col(column).alias(stored) for stored, column in spec.attributes]
    return rows.select(_key_column(spec, rules).alias(spec.key), *attributes)


def source_rows(spec: EntitySpec, cash: DataFrame, card: DataFrame, rules: LoadRules) -> DataFrame:
    """Distinct source rows as (key, attributes…), one per key where the rules ask for a survivor.

    A composite key, or a key that is also the attribute, is derived after the set union, so the
    union does not shuffle the same text twice.
    """
    sources = entity_sources(spec, cash, card)
    if rules.survivor == "max":
        # Maxima are taken over uncleansed values; the result is folded.
        return survivor_by_max(_stored_names(spec, union_all(sources), rules), spec.key, spec.attribute_names)
    if rules.survivor == "priority":
        return survivor_by_priority(ranked_rows(spec, cash, card, rules), spec.key, PRIORITY, spec.attribute_names)
    cleansed = [_cleansed(spec, frame, rules) for frame in sources]
    return _stored_names(spec, union_distinct(cleansed), rules)


def ranked_rows(spec: EntitySpec, cash: DataFrame, card: DataFrame, rules: LoadRules) -> DataFrame:
    """All source rows as (key, attributes…, priority); the first source comes first."""
    frames = [_stored_names(spec, _cleansed(spec, f, rules), rules) for f in entity_sources(spec, cash, card)]
    return union_all([frame.withColumn(PRIORITY, F.lit(rank)) for rank, frame in enumerate(frames, 1)])


def unmatched_rows(spec: EntitySpec, rows: DataFrame, target: DataFrame, rules: LoadRules) -> DataFrame:
    """Source rows the target does not hold, by the rules' notion of a match."""
    if rules.match == "not_in":
        return rows_not_in(rows, spec.key, business_rows(target, spec.id_column), spec.key)
    if rules.match == "attributes":
        return rows_without_match(rows, target, [(a, fold_null(F.col(a))) for a in spec.attribute_names])
    return rows_without_match(rows, target, [(spec.key, F.col(spec.key))])


def entity_columns(spec: EntitySpec, rules: LoadRules) -> list[str]:
    lineage = ["source_system", "source_entity"] + (["source_id"] if rules.with_source_id else [])
    dates = ["start_dt", "end_dt", "is_active", "insert_dt"] if spec.versioned else ["insert_dt", "update_dt"]
    return [spec.id_column, spec.key, *spec.attribute_names, *lineage, *dates]


def new_entity_rows(
    spec: EntitySpec, cash: DataFrame, card: DataFrame, target: DataFrame, as_of: dt.date, rules: LoadRules
) -> DataFrame:
    """Rows to append to the entity, numbered above the keys in use."""
    rows = unmatched_rows(spec, source_rows(spec, cash, card, rules), target, rules)
    base = current_max_key(target, spec.id_column) if rules.continue_ids else 0
    numbered = number_rows(rows, spec.id_column, rules.order or [spec.key], base)
    return numbered.select(*_stored_columns(spec, rules, as_of))


def _stored_columns(spec: EntitySpec, rules: LoadRules, as_of: dt.date) -> list[Column]:
    system, entity = source_systems(spec, rules)
    today = F.lit(as_of)
    values: dict[str, Column] = {
        # Raw rules keep a NULL key but never a NULL attribute.
        **{name: fold_null(F.col(name)) for name in spec.attribute_names},
        "source_system": F.lit(system),
        "source_entity": F.lit(entity),
        "source_id": F.col(spec.key),
        "start_dt": today,
        "end_dt": F.lit(HIGH_DATE),
        "is_active": F.lit("Y"),
        "insert_dt": today,
        "update_dt": today,
    }
    return [values.get(c, F.col(c)).alias(c) for c in entity_columns(spec, rules)]


def entity_default_values(spec: EntitySpec, lineage: str) -> dict[str, Any]:
    """The unknown member of an entity.

    Versioned entities loaded under the manual label carry no source id, like their loaded rows.
    """
    values: dict[str, Any] = {name: UNKNOWN for name in [spec.key, *spec.attribute_names, "source_id"]}
    values |= {"source_system": lineage, "source_entity": lineage, spec.id_column: DEFAULT_KEY}
    values |= {"start_dt": LOW_DATE, "end_dt": HIGH_DATE, "is_active": "Y"}
    values |= {"insert_dt": LOW_DATE, "update_dt": LOW_DATE}
    if spec.versioned and lineage != UNKNOWN:
        values["source_id"] = None
    return values


def entity_default_row(spec: EntitySpec, target: DataFrame, schema: T.StructType, lineage: str) -> DataFrame:
    """The unknown member of an entity if the target lacks it, else no row."""
    return missing_default_row(target, schema, spec.id_column, entity_default_values(spec, lineage))


def with_default(target: DataFrame, default: DataFrame) -> DataFrame:
    return target.unionByName(default)


def count_by(df: DataFrame, column: str, expected: Sequence[str]) -> dict[str, int]:
    """Row counts for a column whose few values are known."""
    counts = df.agg(*[F.count_if(F.col(column) == value).alias(value) for value in expected]).first()
    return {value: counts[value] for value in expected}
