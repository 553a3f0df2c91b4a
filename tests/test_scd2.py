import datetime as dt

import pytest
from conftest import DAY
from pyspark.sql import functions as F

from strataload.operators import scd2
from strataload.sources.schemas import ENTITY_SCHEMAS

SCHEMA = ENTITY_SCHEMAS["bl_3nf.ce_customers_scd"]
LOW, HIGH, BEFORE = dt.date(1900, 1, 1), dt.date(9999, 12, 31), dt.date(2023, 12, 31)
START = dt.date(2023, 1, 1)


@pytest.fixture
def target(frame):
    """Stored versions from (id, key, name, segment, flag)."""

    def build(*rows, default=True):
        full = [(i, k, n, s, "S", "E", None, START, HIGH, flag, START) for i, k, n, s, flag in rows]
        if default:
            full.append((-1, "N/A", "N/A", "N/A", "MANUAL", "MANUAL", None, LOW, HIGH, "Y", LOW))
        return frame(SCHEMA, *full)

    return build


def customer(key, name="Alex", segment="Consumer"):
    return {"customer_id": key, "customer_name": name, "segment": segment}


def changes_of(df):
    rows = df.orderBy("new_customer_id").collect()
    return [(r["change_type"], r["current_customer_id"], r["new_customer_id"], r["customer_src_id"]) for r in rows]


def test_new_changed_and_unchanged(sales, target):
    cash = sales("cash", customer("A"), customer(" B "), customer("C", segment="Home"), customer(None), customer(" "))
    stored = target((1, "B", "Alex", "Consumer", " y "), (2, "C ", "Alex", "Consumer", "Y"), (3, "A", "Alex", "Consumer", "N"))
    changes = scd2.detect_changes(cash, sales("card", customer("B")), stored)
    # A has a closed version only, B is unchanged, C changed its segment.
    assert changes_of(changes) == [("NEW", None, 4, "A"), ("CHANGED", 2, 5, "C")]


def test_cash_wins_over_card(sales, target):
    cash, card = sales("cash", customer("A", "Zoe")), sales("card", customer("A", "Amy"))
    assert scd2.detect_changes(cash, card, target()).first()["customer_name"] == "Zoe"


def test_null_attributes_compare_cleansed(sales, target):
    cash = sales("cash", customer("A", None, " "))
    assert scd2.detect_changes(cash, sales("card", customer("A")), target((1, "A", None, "", "Y"))).count() == 0


def test_apply_closes_and_opens(sales, target):
    cash = sales("cash", customer("A", segment="Home"), customer("B"))
    stored = target((1, "A", "Alex", "Consumer", "Y"))
    changes = scd2.detect_changes(cash, sales("card", customer("B")), stored)
    rows = {r["customer_id"]: r for r in scd2.apply_changes(stored, changes, DAY).collect()}
    assert set(rows) == {-1, 1, 2, 3}
    assert (rows[1]["end_dt"], rows[1]["is_active"], rows[1]["start_dt"]) == (BEFORE, "N", START)
    assert (rows[2]["start_dt"], rows[2]["end_dt"], rows[2]["is_active"], rows[2]["source_id"]) == (DAY, HIGH, "Y", None)
    assert rows[-1]["is_active"] == "Y" and rows[3]["customer_src_id"] == "B"


def test_source_key_that_reads_like_the_unknown_member(sales, target):
    """By default the unknown member is left out of the comparison; the option compares it too."""
    cash, card = sales("cash", customer("N/A")), sales("card", customer("N/A"))
    assert changes_of(scd2.detect_changes(cash, card, target())) == [("NEW", None, 1, "N/A")]
    matched = scd2.detect_changes(cash, card, target(), match_default_row=True)
    assert changes_of(matched) == [("CHANGED", -1, 1, "N/A")]


def test_two_changes_on_one_day_end_before_they_start(sales, target):
    stored = target((1, "A", "Alex", "Consumer", "Y"))
    for segment in ("Home", "Office"):
        cash = sales("cash", customer("A", segment=segment))
        changes = scd2.detect_changes(cash, cash, stored)
        stored = scd2.apply_changes(stored, changes, DAY)
    rows = {r["customer_id"]: r for r in stored.collect()}
    assert (rows[2]["start_dt"], rows[2]["end_dt"]) == (DAY, BEFORE)
    assert rows[3]["is_active"] == "Y"


def test_two_step_load(sales, target):
    cash = sales("cash", customer("A", "Alex", "Home"), customer("A", "Zoe", "Atlas"), customer(None, None, None))
    stored = target((1, "A", "Alex", "Consumer", "Y"), (2, " B", "Bo", None, "Y"))
    after = scd2.apply_two_step(cash, sales("card", customer(" B", "Bo", None)), stored, DAY)
    rows = {r["customer_id"]: r for r in after.collect()}
    # Maxima per column, a stored NULL reads as N/A, and the all-NULL customer equals the default row.
    assert set(rows) == {-1, 1, 2, 3}
    assert (rows[3]["customer_name"], rows[3]["customer_segment"], rows[3]["source_id"]) == ("Zoe", "Home", "A")
    assert rows[1]["is_active"] == "N" and rows[2]["is_active"] == "Y" and rows[-1]["is_active"] == "Y"


def test_two_step_load_never_closes_the_default_row(sales, target):
    cash = sales("cash", customer(None, "Someone"))
    rows = scd2.apply_two_step(cash, cash, target(), DAY).orderBy("customer_id").collect()
    assert [(r["customer_id"], r["customer_name"], r["is_active"]) for r in rows] == [(-1, "N/A", "Y"), (1, "Someone", "Y")]


def test_switching_releases_reports_changes_for_spelling_variants(sales, target):
    cash = sales("cash", customer("A", "Alex"), customer("A", "ALEX"))
    by_maximum = scd2.apply_two_step(cash, cash, target(), DAY)
    assert changes_of(scd2.detect_changes(cash, cash, by_maximum)) == [("CHANGED", 1, 2, "A")]


def test_revert(frame):
    df = frame(
        "customer_id long, customer_segment string, end_dt date, is_active string",
        (1, "Consumer", BEFORE, "N"),
        (2, "SCD2_TEST_SEGMENT", HIGH, "Y"),
        (3, None, HIGH, "Y"),
    )
    reverted = scd2.revert_version(df, F.col("customer_segment") == "SCD2_TEST_SEGMENT", F.col("customer_id") == 1)
    assert sorted(tuple(r) for r in reverted.collect()) == [(1, "Consumer", HIGH, "Y"), (3, None, HIGH, "Y")]


def test_history_of_both_layers(target):
    stored = target((1, "A", "Alex", "Consumer", "Y"), (2, "A", "Alex", "Home", "n "))
    dimension = stored.withColumnRenamed("customer_id", "customer_surr_id").where("customer_surr_id = 1")
    history = scd2.layer_history(stored, dimension).where("customer_src_id = 'A'")
    rows = {r["layer_name"]: tuple(r)[1:] for r in scd2.version_summary(history).collect()}
    assert rows == {"BL_3NF": (2, 1, 1), "BL_DM": (1, 1, 0)}
