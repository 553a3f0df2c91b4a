"""What is shuffled, sorted and written: figures that grow with the tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataload.operators import dedup
from strataload.registry import feed
from strataload.registry.feed import Feed
from strataload.registry.queries import QUERIES
from strataload.sources.csv import split_sales

from conftest import raw_sales


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_with_repeats(spark):
    n = F.when(F.col("id") % 101 != 0, F.col("id") % 2900)
    return spark.range(3000).select(n.cast("string").alias("k"), (-F.col("id")).alias("v"), F.lit("x").alias("t"))


def test_rows_whose_key_occurs_once_are_not_shuffled(spark, no_broadcast, tmp_path):
    rows_with_repeats(spark).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    found = dedup.first_of_repeated(df, ["k"])
    assert "SortMergeJoin" not in plan(found)
    assert sorted(found.collect(), key=str) == sorted(dedup.first_per_key(df, ["k"]).collect(), key=str)


def test_rows_that_share_a_bit_with_a_repeated_key_stay(spark, monkeypatch):
    monkeypatch.setattr(dedup, "_MARK_BITS", 64)
    df = rows_with_repeats(spark)
    want = sorted(dedup.first_per_key(df, ["k"]).collect(), key=str)
    assert sorted(dedup.first_of_repeated(df, ["k"]).collect(), key=str) == want


def test_rejected_and_typed_rows_are_written_without_a_sort(spark):
    raw = raw_sales(spark, "card", {}, {"payment_id": "p2", "sales": "n/a"}, {"payment_id": "p3", "quantity": None})
    good, bad, counts = split_sales(raw)
    assert counts == {"read": 3, "typed": 2, "rejected": 1}
    assert [r["payment_id"] for r in bad.collect()] == ["p2"] and bad.first()["sales"] == "n/a"
    assert sorted(r["payment_id"] for r in good.collect()) == ["p1", "p3"]
    assert not any("rejected=" in f for f in good.inputFiles())


@pytest.fixture
def tables(spark, tmp_path):
    """Two orders with two lines each; order 2 lacks its customer."""
    day = dt.datetime(1998, 1, 2)
    made = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(5, "PERU", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(7, "Ann", 5, 1.0, "MACHINERY")],
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "supplier": ([(3, "Sue", 5, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": (
            [(4, "bolt", "Brand#1", "SMALL", 1)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        ),
        "orders": (
            [(1, 7, "F", day, "2-HIGH"), (2, 8, "O", day, "2-HIGH")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(o, 4, 3, n, 1.0, 9.5, 0.1, "N", "F", day) for o in (1, 2) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return Feed(spark, str(tmp_path))


def test_lines_are_shuffled_for_orders_but_not_again_for_customers(tables, no_broadcast):
    rows = tables.sales("cash", ["payment_id", "customer_id", "customer_name", "country"])
    lines = [x for x in plan(rows).splitlines() if "Exchange hashpartitioning(o_custkey" in x]
    orders = [x for x in plan(rows).splitlines() if "Exchange hashpartitioning(o_orderkey" in x]
    # The exchange for the customers lies below the one for the orders.
    assert len(lines) == len(orders) == 1 and lines[0].index("Exchange") > orders[0].index("Exchange")
    found = sorted(tuple(r) for r in rows.collect())
    assert found[:2] == [("1-1", "7", "Ann", "PERU"), ("1-2", "7", "Ann", "PERU")]
    assert found[2:] == [("2-1", "8", None, None), ("2-2", "8", None, None)]


def test_batches_of_states_are_not_made_distinct_by_order(tables, spark, monkeypatch):
    asked = []
    sales = Feed.sales
    monkeypatch.setattr(Feed, "sales", lambda self, s, names, distinct=False: asked.append(distinct) or sales(self, s, names, distinct))
    assert QUERIES["survivor_state"](spark, tables.directory).count() > 0
    assert asked and not any(asked)


@pytest.mark.parametrize("limit, outermost", [(0, "l_orderkey"), (1 << 30, "l_partkey")])
def test_large_parts_meet_the_lines_before_the_orders(tables, monkeypatch, limit, outermost):
    monkeypatch.setattr(feed, "BROADCAST_BYTES", limit)
    rows = tables.sales("cash", ["payment_id", "order_date", "product_name"])
    joins = [x for x in rows._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in x]
    # The outermost join stands first.
    assert len(joins) == 2 and outermost in joins[0]
    day = dt.date(1998, 1, 2)
    assert sorted(tuple(r) for r in rows.collect()) == [(f"{o}-{n}", day, "bolt") for o in (1, 2) for n in (1, 2)]
