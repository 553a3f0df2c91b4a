"""What differs between the entities, as data. The operators hold what they share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Literal

# Lineage labels of the two source systems.
CASH_SYSTEM, CASH_ENTITY = "SA_CASH_SALES", "SRC_CASH_SALES"
CARD_SYSTEM, CARD_ENTITY = "SA_CARD_SALES", "SRC_CARD_SALES"
MANUAL = "MANUAL"

Keys = Literal["raw", "folded", "cleaned"]
Survivor = Literal["all", "max", "priority"]
Match = Literal["not_in", "key", "attributes"]
Release = Literal["v1", "v2", "v3"]


@dataclass(frozen=True)
class EntitySpec:
    """One normalised entity: where its columns come from and under which names they are stored."""

    name: str
    id_column: str
    key: str
    # (stored attribute, staging column)
    attributes: Sequence[tuple[str, str]]
    # Staging column(s) of the business key. More than one: the key is the parts joined.
    key_parts: Sequence[str]
    card_only: bool = False
    versioned: bool = False

    @property
    def table(self) -> str:
        return f"bl_3nf.ce_{self.name}"

    @property
    def attribute_names(self) -> list[str]:
        return [stored for stored, _ in self.attributes]

    @property
    def staging_columns(self) -> list[str]:
        wanted = [*self.key_parts, *[column for _, column in self.attributes]]
        return list(dict.fromkeys(wanted))


@dataclass(frozen=True)
class LoadRules:
    """How a release of the load treats keys, duplicates and rows that are already there."""

    keys: Keys
    survivor: Survivor
    match: Match
    continue_ids: bool = True
    with_source_id: bool = True
    both_labels: bool = True
    key_separator: str = "_"
    # Columns of a joined key where they are not the entity's key parts.
    joined_columns: Sequence[str] = ()
    default_lineage: str = MANUAL
    order: Sequence[str] = ()


SHIP_MODES = EntitySpec("ship_modes", "ship_mode_id", "ship_mode_src_id", [("ship_mode", "ship_mode")], ["ship_mode"])
RETURNED = EntitySpec(
    "returned", "returned_id", "returned_src_id", [("returned", "returned")], ["returned"], card_only=True
)
PAYMENTS = EntitySpec(
    "payments", "payment_id", "payment_src_id", [("payment_type", "payment_type")], ["payment_type"]
)
LOCATIONS = EntitySpec(
    "locations",
    "location_id",
    "location_src_id",
    [(c, c) for c in ("country", "city", "state", "postal_code", "region")],
    ["country", "city", "state"],
)
EMPLOYEES = EntitySpec(
    "employees", "employee_id", "employee_src_id", [("employee_name", "employee_name")], ["employee_id"]
)
PRODUCTS = EntitySpec(
    "products",
    "product_id",
    "product_src_id",
    [(c, c) for c in ("product_name", "category", "sub_category")],
    ["product_id"],
)
CUSTOMERS = EntitySpec(
    "customers_scd",
    "customer_id",
    "customer_src_id",
    [("customer_name", "customer_name"), ("customer_segment", "segment")],
    ["customer_id"],
    versioned=True,
)

ENTITIES = {
    spec.name: spec for spec in (SHIP_MODES, RETURNED, PAYMENTS, LOCATIONS, EMPLOYEES, PRODUCTS, CUSTOMERS)
}

_V1 = LoadRules(
    "raw", "all", "not_in", continue_ids=False, with_source_id=False, both_labels=False, default_lineage="N/A"
)
_V2 = LoadRules("folded", "all", "key", default_lineage="N/A")
_V3_FOLDED = LoadRules("folded", "all", "key")
_V3_CLEANED = LoadRules("cleaned", "all", "key")


def load_rules(spec: EntitySpec, release: Release = "v3") -> LoadRules:
    """The rules of one release. ``v3`` is the product; the older two stay available."""
    if release == "v1":
        return replace(_V1, order=("country", "city", "state")) if spec is LOCATIONS else _V1
    if release == "v2":
        if spec in (EMPLOYEES, PRODUCTS, CUSTOMERS):
            return replace(_V2, survivor="max")
        if spec is LOCATIONS:
            return replace(_V2, key_separator="|", joined_columns=spec.attribute_names)
        return _V2
    if spec is LOCATIONS:
        return replace(_V3_FOLDED, match="attributes", order=("location_src_id", "postal_code"))
    if spec in (PRODUCTS, CUSTOMERS):
        return replace(_V3_CLEANED, survivor="priority")
    return _V3_CLEANED if spec is EMPLOYEES else _V3_FOLDED


@dataclass(frozen=True)
class DimensionSpec:
    """One star-schema dimension fed from one entity; ``renamed`` maps entity id to surrogate id."""

    entity: EntitySpec
    id_column: str

    @property
    def table(self) -> str:
        return f"bl_dm.dim_{self.entity.name}"

    @property
    def compared(self) -> list[str]:
        return [self.entity.key, *self.entity.attribute_names, "source_system", "source_entity"]


DIMENSIONS = {
    spec.name: DimensionSpec(spec, spec.id_column.replace("_id", "_surr_id")) for spec in ENTITIES.values()
}
CALENDAR_TABLE = "bl_dm.dim_time_day"
CALENDAR_ID = "date_surr_id"
