import datetime as dt

import pytest
from conftest import DAY
from pyspark.sql import functions as F

from strataload.operators import upsert
from strataload.plans.specs import DIMENSIONS
from strataload.sources.csv import typed_sales
from strataload.sources.schemas import ENTITY_SCHEMAS, STAR_SCHEMAS

OLD, FIRST = dt.date(2020, 1, 1), dt.date(2019, 1, 1)
LOW = dt.date(1900, 1, 1)


@pytest.fixture
def employees(frame):
    def build(*rows):
        return frame(ENTITY_SCHEMAS["bl_3nf.ce_employees"], *rows)

    return build


@pytest.fixture
def dimension(frame):
    def build(*rows):
        return frame(STAR_SCHEMAS["bl_dm.dim_employees"], *rows, (-1, *["N/A"] * 4, LOW, LOW))

    return build


def state(spec, entity, target):
    upserts = upsert.dimension_upserts(spec, entity, target, DAY)
    rows = upsert.apply_upserts(target, upserts, spec.id_column).collect()
    return {r[spec.id_column]: r for r in rows}


def test_insert_update_and_keep(employees, dimension):
    spec = DIMENSIONS["employees"]
    entity = employees(
        (1, "E1", "Bob", "S", "E", "E1", OLD, OLD),
        (2, " E2 ", " Eve ", "S", "", "E2", OLD, None),
        (3, "E3", None, "S", "E", "E3", None, OLD),
        (-1, "N/A", "other", "MANUAL", "MANUAL", "N/A", LOW, LOW),
    )
    target = dimension((1, "E1", "Bob", "S", "E", FIRST, FIRST), (2, "E2", "Ann", "S", "N/A", FIRST, FIRST))
    rows = state(spec, entity, target)
    assert {i: r["merge_action"] for i, r in rows.items()} == {1: "keep", 2: "update", 3: "insert", -1: "keep"}
    # An update keeps the first load date and stamps the day of the load.
    assert (rows[2]["employee_src_id"], rows[2]["employee_name"], rows[2]["source_entity"]) == ("E2", "Eve", "N/A")
    assert (rows[2]["insert_dt"], rows[2]["update_dt"]) == (FIRST, DAY)
    assert (rows[1]["insert_dt"], rows[1]["update_dt"]) == (FIRST, FIRST)
    assert (rows[3]["employee_name"], rows[3]["insert_dt"], rows[3]["update_dt"]) == ("N/A", DAY, OLD)
    assert rows[-1]["employee_name"] == "N/A"


def test_null_in_the_dimension_differs_from_a_value(employees, dimension):
    target = dimension((1, "E1", None, "S", "E", FIRST, FIRST))
    rows = state(DIMENSIONS["employees"], employees((1, "E1", "Bob", "S", "E", "E1", OLD, OLD)), target)
    assert rows[1]["merge_action"] == "update"


def test_versioned_dimension_mirrors_every_column(frame):
    spec = DIMENSIONS["customers_scd"]
    entity = frame(
        ENTITY_SCHEMAS["bl_3nf.ce_customers_scd"],
        (1, "A", "Alex", "Home", "S", "E", None, OLD, DAY, " n ", FIRST),
        (2, "A", "Alex", "Office", "S", "E", None, DAY, None, None, DAY),
    )
    stored = (1, "A", "Alex", "Home", "S", "E", OLD, dt.date(9999, 12, 31), "Y", OLD)
    target = frame(STAR_SCHEMAS["bl_dm.dim_customers_scd"], stored)
    rows = state(spec, entity, target)
    assert (rows[1]["end_dt"], rows[1]["is_active"], rows[1]["insert_dt"]) == (DAY, "N", FIRST)
    assert (rows[2]["end_dt"], rows[2]["is_active"], rows[2]["merge_action"]) == (dt.date(9999, 12, 31), "Y", "insert")


def test_rerun_writes_nothing(employees, dimension):
    spec = DIMENSIONS["employees"]
    entity = employees((1, "E1", "Bob", "S", "E", "E1", OLD, OLD))
    target = dimension()
    first = upsert.dimension_upserts(spec, entity, target, DAY)
    after = upsert.apply_upserts(target, first, spec.id_column).drop("merge_action")
    assert upsert.dimension_upserts(spec, entity, after, DAY).count() == 0


def test_calendar_holds_observed_days_only(sales, frame):
    cash = typed_sales(sales("cash", {"order_date": "2024-01-05", "ship_date": None}))
    card = typed_sales(sales("card", {"order_date": "2024-01-05", "ship_date": "2024-01-07"}))
    target = frame(STAR_SCHEMAS["bl_dm.dim_time_day"], (20240105, dt.date(2024, 1, 5), 5, "Freitag", 1, "January", 1, 2024, 0))
    rows = {r["date_surr_id"]: (r["merge_action"], r["day_name"]) for r in upsert.calendar_upserts(cash, card, target).collect()}
    assert rows == {20240105: ("update", "Friday"), 20240107: ("insert", "Sunday")}


def test_calendar_reads_each_source_once(sales):
    plan = upsert.calendar_rows(typed_sales(sales("cash", {})), typed_sales(sales("card", {})))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ExistingRDD") == 2 and text.count("Exchange") == 1


def test_product_rows_have_the_declared_layout(frame):
    spec = DIMENSIONS["products"]
    entity = frame(ENTITY_SCHEMAS["bl_3nf.ce_products"], (1, " P ", "", "c", None, "S", "E", "P", None, OLD))
    rows = upsert.dimension_rows(spec, entity, DAY)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in STAR_SCHEMAS[spec.table]]
    assert rows.select(F.col("product_src_id"), "product_name", "sub_category", "insert_dt").first() == ("P", "N/A", "N/A", DAY)
