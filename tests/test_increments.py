"""State that merges, checks in one scan, fingerprints, profiles, facts and rebuilt histories on hand-made rows."""

import datetime as dt
import itertools
from decimal import Decimal
from functools import partial

import pytest
from conftest import DAY
from pyspark.sql import functions as F

from strataload.operators import dedup, facts, matching, profile, quality, scd2
from strataload.plans import loads, validation
from strataload.plans.load_log import LOG_TABLE
from strataload.plans.specs import CUSTOMERS, DIMENSIONS
from strataload.session import materialize
from strataload.sources.csv import split_sales, stage_sales

NEXT = DAY + dt.timedelta(days=1)
HIGH = dt.date(9999, 12, 31)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# One row per key


def test_repeated_keys_are_ranked_and_others_pass(frame):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), (None, 4, "n"), (None, 3, "m"), ("c", None, "z")]
    df = frame("k string, v int, t string", *rows)
    want = values(dedup.first_per_key(df, ["k"]))
    for partitions in (1, 5):
        assert values(dedup.first_of_repeated(df.repartition(partitions), ["k"])) == want
    assert values(dedup.first_of_repeated(df.limit(0), ["k"])) == []
    assert values(dedup.first_of_repeated(df.select("k"), ["k"])) == values(df.select("k").distinct())


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_state_of_batches_in_any_order_is_that_of_all_rows(frame, order):
    batches = [
        [("x", 2, "A", "A"), ("y", 1, "Q", None), (None, 1, "n", "n")],
        [("x", 1, "C", "A"), ("z", 2, "k", "k"), ("z", 2, "k", "k")],
        [("x", 1, "B", "Z"), ("y", 2, "A", "A"), (None, 1, "m", "m")],
    ]
    schema = "k string, pr int, a string, b string"
    first = partial(dedup.survivor_state, key="k", priority="pr", attributes=["a", "b"])
    most = partial(dedup.maxima_state, key="k", attributes=["a", "b"])
    every = frame(schema, *itertools.chain(*batches))
    for reduce_rows, columns in ((first, ["k", "pr", "a", "b"]), (most, ["k", "a", "b"])):
        state = reduce_rows(frame(schema).select(*columns))
        for i in order:
            batch = frame(schema, *batches[i]).select(*columns)
            touched = dedup.merge_state(state, batch, ["k"], reduce_rows)
            same = [state["k"].eqNullSafe(touched["k"])]
            state = state.join(touched, same, "left_anti").unionByName(touched)
        assert values(state) == values(reduce_rows(every.select(*columns)))


# Checks


def test_rules_in_one_scan_equal_one_check_each(frame):
    rows = [(1, " a", "Y", DAY), (2, "a", "y ", DAY), (2, "b", "N", DAY), (-1, "N/A", "Y", None), (4, None, "Y", DAY), (5, None, "Y", DAY)]
    df = frame("id long, k string, active string, start_dt date", *rows)
    active = F.upper(F.trim("active")) == "Y"
    rules = {
        "id": ([F.col("id")], None),
        "active": ([F.trim("k")], active),
        "version": ([F.trim("k"), F.col("start_dt")], F.col("id") != -1),
    }
    found = values(quality.rule_violations(df, rules))
    want = []
    for name, (keys, where) in rules.items():
        for r in quality.unique_violations(df, keys, where).collect():
            parts = [str(v) for v in tuple(r)[:-1]]
            want.append((name, parts[0], parts[1] if len(parts) > 1 else None, r["row_count"]))
    assert found == sorted(want, key=str) and len(found) == 3
    report = quality.checked_while_written(df, "id", rules, partial(materialize, label="checked"))
    counts = {r["check_name"]: r["row_count"] for r in report.where("key_1 is null").collect()}
    assert counts == {"total_rows": 6, "default_rows": 1, "business_rows": 5, "rows_without_id": 0}
    assert report.count() == 4 + len(found)


def test_layers_that_agree_compare_no_row(frame, monkeypatch):
    schema = "id long, a string, b string, d date"
    rows = [(i, f"v{i}", None if i % 3 else "x", DAY) for i in range(200)]
    left, right = frame(schema, *rows), frame(schema, *reversed(rows)).toDF("key", "p", "q", "r")
    assert quality.differing_buckets(left, right, 64) == []
    changed = [(i, "w" if i == 77 else a, b, d) for i, a, b, d in rows if i != 5]
    other = frame(schema, *changed, (900, "new", None, None))
    assert 1 <= len(quality.differing_buckets(left, other, 64)) <= 3
    for there in (right, other, left.limit(0), frame(schema, *rows, *rows[:9])):
        want = values(quality.reconcile(left, there, "l", "r"))
        assert values(quality.reconcile_by_buckets(left, there, "l", "r", 64)) == want
    plan = quality.reconcile_by_buckets(left, right, "l", "r", 64)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan or "LogicalRDD" not in plan


def test_null_and_its_place_count_in_a_fingerprint(frame):
    one, two = frame("id long, a string, b string", (1, "x", None)), frame("id long, a string, b string", (1, None, "x"))
    assert quality.differing_buckets(one, two, 8) != []


# Profiles


def test_merged_profile_is_that_of_the_whole(frame):
    rows = [(f"k{i % 700}", Decimal(i) / 4 if i % 50 else None, " " if i % 9 == 0 else "t") for i in range(3000)]
    schema = "k string, v decimal(18,4), t string"
    parts = [profile.batch_profile(frame(schema, *rows[i::3]), ["k", "v", "t"]) for i in range(3)]
    got = {r["column_name"]: r for r in profile.merge_profiles(parts).collect()}
    assert {n: (r["row_count"], r["null_count"], r["blank_count"]) for n, r in got.items()} == {
        "k": (3000, 0, 0), "v": (3000, 60, 0), "t": (3000, 0, 334),
    }
    assert (got["k"]["smallest"], got["k"]["largest"]) == ("k0", "k99")
    assert (Decimal(got["v"]["smallest"]), Decimal(got["v"]["largest"])) == (Decimal("0.25"), Decimal("749.75"))
    assert abs(got["k"]["distinct_estimate"] - 700) <= 42 and got["t"]["distinct_estimate"] == 2
    assert abs(got["v"]["median_estimate"] - 375) <= 0.05 * 750 and got["k"]["median_estimate"] is None
    empty = profile.merge_profiles([profile.batch_profile(frame(schema), ["k", "v"])]).collect()
    assert {(r["row_count"], r["smallest"], r["median_estimate"]) for r in empty} == {(0, None, None)}


# Histories


def test_history_from_states_in_any_order(frame):
    d = [DAY + dt.timedelta(days=i) for i in range(6)]
    events = [
        ("a", d[0], 1, "x"), ("a", d[2], 1, "y"), ("a", d[2], 2, "z"), ("a", d[3], 1, "z"), ("a", d[5], 1, "x"),
        ("b", d[1], 1, None), ("b", d[4], 1, "q"), (None, d[0], 1, "n"), ("a", d[0], 1, "x"),
    ]
    want = [
        ("a", "x", d[0], d[1], "N"), ("a", "z", d[2], d[4], "N"), ("a", "x", d[5], HIGH, "Y"),
        ("b", None, d[1], d[3], "N"), ("b", "q", d[4], HIGH, "Y"), (None, "n", d[0], HIGH, "Y"),
    ]
    schema = "k string, day date, turn int, a string"
    for rows in (events, events[::-1]):
        got = scd2.rebuild_versions(frame(schema, *rows).repartition(4), "k", ["a"], "day", ["turn"])
        assert values(got) == sorted(want, key=str)
    assert scd2.rebuild_versions(frame(schema), "k", ["a"], "day").count() == 0


def test_two_changes_on_one_day_and_a_late_one(warehouse, sales):
    loads.load_staging(warehouse, sales("cash", {}), sales("card", {"payment_id": "c1", "customer_id": "BB-1"}))
    loads.load_all(warehouse, DAY)
    dimension = DIMENSIONS[CUSTOMERS.name]

    def change(payment, day, **values_):
        loads.load_staging(warehouse, sales("cash", {"payment_id": payment, **values_}), sales("card"))
        affected = loads.load_entity(warehouse, CUSTOMERS, day, rebuild=True, raise_on_error=True)
        assert loads.load_dimension(warehouse, dimension, day, raise_on_error=True) == affected
        rows = validation.customer_history(warehouse, F.col("customer_src_id") == "AA-10315").collect()
        layers = [
            sorted((r["start_dt"], r["end_dt"], r["customer_name"], r["is_active"]) for r in rows if r["layer_name"] == layer)
            for layer in ("BL_3NF", "BL_DM")
        ]
        assert layers[0] == layers[1]
        return affected, layers[0]

    # The smallest name survives, so every change takes one below the last.
    far = DAY + dt.timedelta(days=9)
    assert change("p2", far, customer_name="Alex A") == (
        2, [(DAY, far - dt.timedelta(days=1), "Alex Avila", "N"), (far, HIGH, "Alex A", "Y")],
    )
    affected, history = change("p3", far, customer_name="Al")
    assert (affected, history[1:]) == (1, [(far, HIGH, "Al", "Y")])
    # A change that becomes known for a day before the last version's.
    affected, history = change("p4", NEXT, customer_name="A")
    assert [h[:3] for h in history] == [(DAY, DAY, "Alex Avila"), (NEXT, far - dt.timedelta(days=1), "A"), (far, HIGH, "Al")]
    assert affected == 2
    assert validation.active_versions(warehouse).count() == 0
    other = validation.customer_history(warehouse, F.col("customer_src_id") == "BB-1")
    assert other.count() == 2


# Facts


def test_hot_keys_join_as_others_do(frame):
    left = frame("k string, p string, d int", *[("hot" if i % 3 == 0 else f"k{i}", f"p{i}", i % 10) for i in range(300)], (None, "pn", 1))
    right = frame("k string, low int, high int", ("hot", 0, 4), ("hot", 5, 7), ("k1", 0, 9), ("k2", 9, 9))
    valid = F.col("d").between(F.col("low"), F.col("high"))
    assert matching.hot_keys(left, "k", 0.1) == ["hot"]
    plain = left.join(right.withColumnRenamed("k", "r"), (F.col("k") == F.col("r")) & valid, "left").drop("r")
    assert values(matching.join_hot_keys(left, right, "k", "p", valid, 0.1, 8)) == values(plain)
    assert matching.join_hot_keys(left.limit(0), right, "k", "p", valid).count() == 0


def test_customer_version_of_the_order_date(frame):
    versions = frame(
        "customer_surr_id long, customer_src_id string, start_dt date, end_dt date",
        (1, "a", dt.date(2020, 1, 1), dt.date(2020, 12, 31)), (2, " a ", dt.date(2021, 1, 1), HIGH),
        (3, "b", dt.date(2021, 1, 1), HIGH), (-1, "N/A", dt.date(1900, 1, 1), HIGH),
    )
    rows = [
        ("1", "a", dt.date(2020, 12, 31)), ("2", "a ", dt.date(2021, 1, 1)), ("3", "a", dt.date(2019, 1, 1)),
        ("4", "b", None), ("5", None, DAY), ("6", "c", DAY), ("7", "N/A", DAY), ("8", "b", DAY),
    ]
    got = facts.with_customer_version(frame("payment_id string, customer_id string, order_date date", *rows), versions)
    assert {r["payment_id"]: r["customer_surr_id"] for r in got.collect()} == {
        "1": 1, "2": 2, "3": -1, "4": -1, "5": -1, "6": -1, "7": -1, "8": 3,
    }


def test_facts_of_new_batches(warehouse, sales):
    odd = {"payment_id": "p2", "customer_id": "?", "sales": "0", "returned": "Yes"}
    loads.load_staging(warehouse, sales("cash", {"order_date": "2024-02-01"}), sales("card", {"payment_id": "c1", "order_date": "2023-01-01"}))
    loads.load_all(warehouse, DAY)
    assert loads.load_facts(warehouse, DAY) == 2
    rows = {r["payment_id"]: r for r in warehouse.read(loads.FACT_TABLE).collect()}
    assert (rows["p1"]["customer_surr_id"], rows["p1"]["returned_surr_id"], rows["c1"]["returned_surr_id"]) == (1, -1, 1)
    # The first version starts on the day of the first load.
    assert rows["c1"]["customer_surr_id"] == -1 and rows["p1"]["order_date_surr_id"] == 20240201
    assert rows["p1"]["profit_ratio"] == Decimal("-0.2975") and all(rows["p1"][c] > 0 for c in rows["p1"].asDict() if c.endswith("surr_id") and c != "returned_surr_id")
    assert loads.load_facts(warehouse, DAY) == 0
    before = set(warehouse.read(loads.FACT_TABLE).inputFiles())
    loads.load_staging(warehouse, sales("cash", odd), sales("card"))
    assert loads.load_facts(warehouse, NEXT) == 1 and before < set(warehouse.read(loads.FACT_TABLE).inputFiles())
    late = warehouse.read(loads.FACT_TABLE).where("payment_id = 'p2'").first()
    assert (late["customer_surr_id"], late["profit_ratio"], late["insert_dt"]) == (-1, None, NEXT)
    # After a forgotten mark the folders of the batches are written again, not doubled.
    loads.forget_progress(warehouse)
    assert loads.load_facts(warehouse, DAY) == 3 and warehouse.count(loads.FACT_TABLE) == 3


# Quarantine


def test_rejected_rows_are_listed_and_good_ones_load(warehouse, sales):
    card = sales("card", {"payment_id": "c1"}, {"payment_id": "c2", "sales": "x", "quantity": "1.5"}, {"payment_id": "c3", "order_date": "2024-02-30"})
    good, bad, counts = split_sales(card)
    assert counts == {"read": 3, "typed": 1, "rejected": 2} and values(good) == values(stage_sales(card.where("payment_id = 'c1'")))
    assert {r["payment_id"]: (r["sales"], r["reasons"]) for r in bad.collect()} == {
        "c2": ("x", ["sales does not fit decimal(18,4): x", "quantity does not fit int: 1.5"]),
        "c3": ("10.5", ["order_date does not fit date: 2024-02-30"]),
    }
    assert loads.load_staging(warehouse, sales("cash", {}), card, quarantine=True) == 2
    assert warehouse.count(loads.CASH_TABLE) == warehouse.count(loads.CARD_TABLE) == 1
    kept = warehouse.read(loads.REJECTED_TABLE).collect()
    assert {(r["batch"], r["source_table"]) for r in kept} == {(1, loads.CARD_TABLE)} and len(kept) == 2
    assert any('"payment_id":"c2"' in r["row_text"] and '"sales":"x"' in r["row_text"] for r in kept)
    log = warehouse.read(LOG_TABLE).collect()
    assert [(r["procedure_name"], r["rows_affected"], r["status"]) for r in log] == [("prc_load_staging", 2, "SUCCESS")]


def test_failed_staging_is_logged(warehouse, sales):
    assert loads.load_staging(warehouse, sales("cash", {}), sales("card", {"sales": "x"}), raise_on_error=False) is None
    entry = warehouse.read(LOG_TABLE).first()
    assert (entry["status"], entry["rows_affected"]) == ("ERROR", 0) and "does not fit" in entry["error_message"]
