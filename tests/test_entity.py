from dataclasses import replace

import pytest
from conftest import DAY

from strataload.operators.entity import entity_default_row, new_entity_rows, source_rows
from strataload.operators.rows import empty_frame
from strataload.plans.specs import CUSTOMERS, EMPLOYEES, LOCATIONS, PRODUCTS, RETURNED, SHIP_MODES, load_rules
from strataload.sources.schemas import ENTITY_SCHEMAS

# The source systems mix NULL, blank, padded and repeated values.
MODES = [{"ship_mode": "Air", "payment_id": "1"}, {"ship_mode": None, "payment_id": "2"}, {"ship_mode": ""}]


def loaded(spec, cash, card, target, release="v3"):
    rows = new_entity_rows(spec, cash, card, target, DAY, load_rules(spec, release))
    return rows.orderBy(spec.id_column).collect()


@pytest.fixture
def empty(spark):
    return lambda spec: empty_frame(spark, ENTITY_SCHEMAS[spec.table])


@pytest.fixture
def with_default(spark, empty):
    def build(spec, lineage="MANUAL"):
        frame = empty(spec)
        return frame.unionByName(entity_default_row(spec, frame, ENTITY_SCHEMAS[spec.table], lineage))

    return build


def test_folded_key_matches_the_default_row(sales, with_default):
    rows = loaded(SHIP_MODES, sales("cash", *MODES), sales("card", {"ship_mode": "Air"}), with_default(SHIP_MODES))
    assert [(r["ship_mode_id"], r["ship_mode_src_id"], r["source_id"]) for r in rows] == [(1, "", ""), (2, "Air", "Air")]
    assert {r["source_system"] for r in rows} == {"SA_CASH_SALES/SA_CARD_SALES"}
    assert {(r["insert_dt"], r["update_dt"]) for r in rows} == {(DAY, DAY)}


def test_card_only_entity(sales, with_default):
    card = sales("card", {"returned": "Yes"}, {"returned": None})
    rows = loaded(RETURNED, sales("cash", {}), card, with_default(RETURNED))
    assert [(r["returned"], r["source_system"]) for r in rows] == [("Yes", "SA_CARD_SALES")]


def test_second_load_finds_nothing_and_ids_continue(sales, with_default):
    cash, card = sales("cash", *MODES), sales("card", {"ship_mode": "Rail"})
    target = with_default(SHIP_MODES)
    first = new_entity_rows(SHIP_MODES, cash, card, target, DAY, load_rules(SHIP_MODES))
    target = target.unionByName(first)
    assert loaded(SHIP_MODES, cash, card, target) == []
    more = loaded(SHIP_MODES, cash, sales("card", {"ship_mode": "Ship"}), target)
    assert [(r["ship_mode_id"], r["ship_mode"]) for r in more] == [(4, "Ship")]


def test_v1_null_key_depends_on_the_target(sales, empty, frame):
    cash, card = sales("cash", *MODES), sales("card", {"ship_mode": "Air"})
    rows = loaded(SHIP_MODES, cash, card, empty(SHIP_MODES), "v1")
    assert [(r["ship_mode_id"], r["ship_mode_src_id"], r["ship_mode"]) for r in rows] == [
        (1, "", ""),
        (2, "Air", "Air"),
        (3, None, "N/A"),
    ]
    assert "source_id" not in rows[0].asDict() and rows[0]["source_system"] == "SA_CASH_SALES"
    one = frame("ship_mode_id long, ship_mode_src_id string", (1, "Air"))
    # Ids start at 1 again, so this load would collide with the stored key.
    assert [(r["ship_mode_id"], r["ship_mode_src_id"]) for r in loaded(SHIP_MODES, cash, card, one, "v1")] == [(1, "")]
    poisoned = frame("ship_mode_id long, ship_mode_src_id string", (1, None))
    assert loaded(SHIP_MODES, cash, card, poisoned, "v1") == []


PLACES = [
    {"postal_code": "1"},
    {"postal_code": "2"},
    {"city": None, "state": None, "postal_code": None, "region": None, "country": None},
]


def test_locations_v3_share_a_key_between_postal_codes(sales, with_default):
    rows = loaded(LOCATIONS, sales("cash", *PLACES), sales("card", PLACES[0]), with_default(LOCATIONS))
    # All NULL equals the default row in all five attributes.
    assert [(r["location_id"], r["location_src_id"], r["postal_code"]) for r in rows] == [
        (1, "US_Austin_Texas", "1"),
        (2, "US_Austin_Texas", "2"),
    ]


def test_locations_v2_key_holds_every_attribute(sales, with_default):
    rows = loaded(LOCATIONS, sales("cash", *PLACES), sales("card", PLACES[0]), with_default(LOCATIONS), "v2")
    assert [r["location_src_id"] for r in rows] == [
        "N/A|N/A|N/A|N/A|N/A",
        "US|Austin|Texas|1|South",
        "US|Austin|Texas|2|South",
    ]


def test_locations_v1_key_treats_null_as_empty(sales, empty):
    rows = loaded(LOCATIONS, sales("cash", *PLACES), sales("card", PLACES[0]), empty(LOCATIONS), "v1")
    assert [(r["location_src_id"], r["postal_code"]) for r in rows] == [
        ("US_Austin_Texas", "1"),
        ("US_Austin_Texas", "2"),
        ("__", "N/A"),
    ]


STAFF = [
    {"employee_id": " E1 ", "employee_name": "Bob"},
    {"employee_id": "E1", "employee_name": "Rob"},
    {"employee_id": "  ", "employee_name": "x"},
    {"employee_id": None, "employee_name": "y"},
    {"employee_id": "E2", "employee_name": " "},
]


def test_employees_v3_keep_both_names_and_drop_blank_keys(sales, with_default):
    rows = loaded(EMPLOYEES, sales("cash", *STAFF), sales("card", STAFF[0]), with_default(EMPLOYEES))
    assert [(r["employee_id"], r["employee_src_id"], r["employee_name"]) for r in rows] == [
        (1, "E1", "Bob"),
        (2, "E1", "Rob"),
        (3, "E2", "N/A"),
    ]


def test_employees_v2_take_the_greatest_name(sales, with_default):
    rows = loaded(EMPLOYEES, sales("cash", *STAFF), sales("card", STAFF[0]), with_default(EMPLOYEES), "v2")
    assert [(r["employee_src_id"], r["employee_name"]) for r in rows] == [
        ("  ", "x"),
        (" E1 ", "Bob"),
        ("E1", "Rob"),
        ("E2", " "),
    ]


def test_trimmed_source_key_is_compared_with_the_stored_key_as_it_is(sales, frame):
    padded = frame("employee_id long, employee_src_id string", (5, " E1 "))
    rows = loaded(EMPLOYEES, sales("cash", STAFF[1]), sales("card", STAFF[1]), padded)
    assert [(r["employee_id"], r["employee_src_id"]) for r in rows] == [(6, "E1")]


GOODS = [{"product_name": "B", "category": "Y"}, {"product_name": "B", "category": "X"}]


def test_products_v3_prefer_cash_then_the_smallest_attributes(sales, with_default):
    card = sales("card", {"product_name": "A"})
    rows = loaded(PRODUCTS, sales("cash", *GOODS), card, with_default(PRODUCTS))
    assert [(r["product_src_id"], r["product_name"], r["category"]) for r in rows] == [("P1", "B", "X")]


def test_products_v2_may_mix_variants(sales, with_default):
    card = sales("card", {"product_name": "C", "category": "W"})
    rows = loaded(PRODUCTS, sales("cash", *GOODS), card, with_default(PRODUCTS), "v2")
    assert [(r["product_name"], r["category"]) for r in rows] == [("C", "Y")]


def test_products_v1_keep_all_variants(sales, empty):
    card = sales("card", {"product_name": "C", "category": "W"})
    assert len(loaded(PRODUCTS, sales("cash", *GOODS), card, empty(PRODUCTS), "v1")) == 3


def test_customers_v1_insert_only(sales, empty):
    rows = loaded(CUSTOMERS, sales("cash", {}), sales("card", {}), empty(CUSTOMERS), "v1")
    assert len(rows) == 1 and rows[0]["is_active"] == "Y" and str(rows[0]["end_dt"]) == "9999-12-31"


def test_set_union_shuffles_one_copy_of_the_text(sales):
    rules = replace(load_rules(SHIP_MODES))
    plan = source_rows(SHIP_MODES, sales("cash", {}), sales("card", {}), rules)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


@pytest.mark.parametrize("lineage, source_id", [("MANUAL", None), ("N/A", "N/A")])
def test_default_customer(empty, lineage, source_id):
    frame = empty(CUSTOMERS)
    row = entity_default_row(CUSTOMERS, frame, ENTITY_SCHEMAS[CUSTOMERS.table], lineage).first()
    assert (row["customer_id"], row["customer_src_id"], row["source_system"], row["source_id"]) == (
        -1,
        "N/A",
        lineage,
        source_id,
    )
    assert (str(row["start_dt"]), str(row["end_dt"]), row["is_active"]) == ("1900-01-01", "9999-12-31", "Y")
