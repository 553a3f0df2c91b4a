import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.operators.quality import ConstraintViolation, primary_key_check, require_none
from strataload.sources.csv import read_sales_csv, stage_sales, typed_sales, write_sales_csv
from strataload.sources.schemas import CASH_COLUMNS
from strataload.sources.warehouse import MissingTable, Warehouse

NAMES = ["id", "name"]
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_reads_nulls_blanks_and_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name\n1,\n2,""\n3,"a ""b"", c"\n04, d \n')
    assert values(read_sales_csv(spark, str(path), NAMES)) == [
        ("04", " d "),
        ("1", None),
        ("2", ""),
        ("3", 'a "b", c'),
    ]


@pytest.mark.parametrize("line", ["1", "1,2,3"])
def test_csv_line_with_wrong_width_is_an_error(spark, tmp_path, line):
    path = tmp_path / "in.csv"
    path.write_text(f"id,name\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_sales_csv(spark, str(path), NAMES).collect()


def test_csv_round_trip(spark, frame, tmp_path):
    rows = [("1", None), ("2", ""), (" 3", 'say "x", y'), ("4 ", "  ")]
    write_sales_csv(frame("id string, name string", *rows), str(tmp_path / "out"))
    assert values(read_sales_csv(spark, str(tmp_path / "out"), NAMES)) == sorted(rows, key=str)


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name\n1,"a\nb"\n')
    assert values(read_sales_csv(spark, str(path), NAMES, multi_line=True)) == [("1", "a\nb")]


def test_staging_casts_and_keeps_one_row_per_payment(sales):
    raw = sales("cash", {"quantity": "3"}, {"quantity": "2"}, {"payment_id": "p2", "sales": " 7 "})
    rows = {r["payment_id"]: r for r in stage_sales(raw).collect()}
    assert len(rows) == 2
    assert rows["p1"]["quantity"] == 2 and rows["p1"]["profit"] == Decimal("-3.1234")
    assert rows["p2"]["sales"] == Decimal("7.0000") and rows["p2"]["order_date"] == dt.date(2024, 1, 5)
    assert stage_sales(raw).columns == CASH_COLUMNS


@pytest.mark.parametrize("bad", [{"profit": "1.23456"}, {"discount": "0.00004"}, {"sales": "x"}, {"quantity": ""}, {"order_date": "2024-13-01"}])
def test_bad_value_is_an_error(sales, bad):
    with pytest.raises(Exception, match="does not fit"):
        typed_sales(sales("cash", bad)).collect()


def test_errors_do_not_depend_on_session_settings(spark, sales):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="does not fit"):
            typed_sales(sales("cash", {"order_date": "junk"})).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_zeros_after_the_fourth_decimal_are_no_loss(sales):
    assert str(typed_sales(sales("cash", {"profit": "1.234500"})).first()["profit"]) == "1.2345"


def test_swapped_header_and_short_line_are_errors_under_pruning(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text("b,a\n1,2\n")
    (tmp_path / "short.csv").write_text("a,b,c\n1,2\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, str(tmp_path / "swapped.csv"), ["a", "b"]).select("a").collect()
    with pytest.raises(Exception):
        read_sales_csv(spark, str(tmp_path / "short.csv"), ["a", "b", "c"]).select("a").collect()


def test_dates_in_another_format(sales):
    typed = typed_sales(sales("cash", {"order_date": "1/5/2024", "ship_date": "11/12/2024"}), "M/d/yyyy")
    assert typed.select("order_date", "ship_date").first() == (dt.date(2024, 1, 5), dt.date(2024, 11, 12))


@pytest.fixture
def small(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), {"lab.person": SCHEMA})


def test_table_life(small, frame):
    with pytest.raises(MissingTable):
        small.read("lab.person")
    assert small.create_if_absent("lab.person") and not small.create_if_absent("lab.person")
    assert small.count("lab.person") == 0
    small.append("lab.person", frame(SCHEMA, (1, "Bob")))
    small.append("lab.person", frame(SCHEMA, (2, "Alice")))
    assert values(small.read("lab.person")) == [(1, "Bob"), (2, "Alice")]
    small.replace("lab.person", small.read("lab.person").where("id = 2"))
    assert values(small.read("lab.person")) == [(2, "Alice")]
    small.truncate("lab.person")
    assert small.count("lab.person") == 0 and small.exists("lab.person")
    assert small.drop_if_exists("lab.person") and not small.drop_if_exists("lab.person")


KEYED = T.StructType([*SCHEMA.fields, T.StructField("note", T.StringType())])


@pytest.fixture
def keyed(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), {"lab.person": KEYED}, {"lab.person": ("id", "name")}, buckets=8)


def files(warehouse, table="lab.person"):
    return {f for f in warehouse.read(table).inputFiles()}


def test_merge_writes_only_the_folders_of_changed_keys(keyed, frame):
    people = [(i, f"person {i}", "old") for i in range(40)]
    keyed.append("lab.person", frame(KEYED, *people))
    before = files(keyed)
    assert len(before) == 8
    keyed.merge("lab.person", frame(KEYED, (7, "person 7", "new"), (50, " person 7 ", "second")))
    after = files(keyed)
    assert len(before - after) == len(after - before) == 1
    want = [(i, f"person {i}", "new" if i == 7 else "old") for i in range(40)] + [(50, " person 7 ", "second")]
    assert values(keyed.read("lab.person")) == sorted(want, key=str)
    assert values(keyed.read_key("lab.person", "person 7")) == [(50, " person 7 ", "second"), (7, "person 7", "new")]


def test_merge_moves_a_row_whose_key_changed(keyed, frame):
    keyed.append("lab.person", frame(KEYED, *[(i, f"person {i}", None) for i in range(20)]))
    keyed.merge("lab.person", frame(KEYED, (3, "renamed", None), (4, None, None)))
    rows = {r[0]: r[1] for r in keyed.read("lab.person").collect()}
    assert len(rows) == keyed.count("lab.person") == 20 and (rows[3], rows[4], rows[5]) == ("renamed", None, "person 5")


def test_merge_deletes_and_leaves_no_empty_folder_behind(keyed, frame):
    keyed.append("lab.person", frame(KEYED, (1, "a", None), (2, "b", None)))
    keyed.merge("lab.person", frame(KEYED), deleted=frame("id long", (1,)))
    assert values(keyed.read("lab.person")) == [(2, "b", None)] and len(files(keyed)) == 1
    before = files(keyed)
    keyed.merge("lab.person", frame(KEYED))
    assert files(keyed) == before


def test_failed_merge_leaves_the_table_as_it_was(keyed, frame):
    keyed.append("lab.person", frame(KEYED, (1, "Bob", "x")))
    before = files(keyed)
    rule = require_none(lambda df: df.where("note = 'bad'"), "no bad notes")
    with pytest.raises(ConstraintViolation):
        keyed.merge("lab.person", frame(KEYED, (1, "Bob", "bad")), [rule])
    assert files(keyed) == before and values(keyed.read("lab.person")) == [(1, "Bob", "x")]


def test_another_number_of_folders_is_refused(spark, keyed, frame):
    keyed.append("lab.person", frame(KEYED, (1, "Bob", "x")))
    other = Warehouse(spark, keyed.root, keyed.schemas, keyed.keys, buckets=4)
    other.append("lab.person", frame(KEYED, (2, "Eve", "y")))
    with pytest.raises(Exception, match="(?i)conflicting"):
        other.read("lab.person").collect()


def test_batches_are_read_after_a_mark(warehouse, sales):
    table = "sa_cash_sales.src_cash_sales"
    assert warehouse.last_batch(table) == 0
    for batch in (1, 2, 3):
        warehouse.append_batch(table, typed_sales(sales("cash", {"payment_id": f"p{batch}"})), batch)
    assert warehouse.last_batch(table) == 3
    later = warehouse.read_after(table, 1)
    assert {r["payment_id"] for r in later.collect()} == {"p2", "p3"} and later.columns == CASH_COLUMNS
    plan = later._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(load_batch" in plan and "load_batch#" in plan
    kept = files(warehouse, table)
    warehouse.rewrite_batches(table, F.col("payment_id") == "p2", lambda rows: rows.withColumn("segment", F.lit("new")))
    assert len(kept - files(warehouse, table)) == 1
    assert {r["payment_id"]: r["segment"] for r in warehouse.read(table).collect()} == {"p1": "Consumer", "p2": "new", "p3": "Consumer"}


def test_failed_check_leaves_the_table_as_it_was(small, frame):
    small.append("lab.person", frame(SCHEMA, (1, "Bob")))
    with pytest.raises(ConstraintViolation):
        small.append("lab.person", frame(SCHEMA, (1, "Twin")), [primary_key_check("id")])
    assert values(small.read("lab.person")) == [(1, "Bob")]


def test_column_added_later_reads_as_null_in_older_files(spark, tmp_path, frame):
    root = str(tmp_path / "w")
    Warehouse(spark, root, {"t.x": SCHEMA}).append("t.x", frame(SCHEMA, (1, "a")))
    wider = T.StructType([*SCHEMA.fields, T.StructField("source_id", T.StringType())])
    later = Warehouse(spark, root, {"t.x": wider})
    later.append("t.x", frame(wider, (2, "b", "s")))
    assert values(later.read("t.x")) == [(1, "a", None), (2, "b", "s")]
