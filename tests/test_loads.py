import datetime as dt
import shutil
from threading import Barrier, Event
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from conftest import DAY, raw_sales
from pyspark.sql import functions as F

from strataload.operators.scd2 import CloseMismatch, version_summary
from strataload.plans import corrections, loads, validation
from strataload.plans.load_log import LOG_TABLE, last_mark, write_log
from strataload.plans.specs import CUSTOMERS, DIMENSIONS, ENTITIES
from strataload.sources.warehouse import Warehouse

NEXT = DAY + dt.timedelta(days=1)
BOB = {"payment_id": "p2", "customer_id": "BB-1", "customer_name": "Bob", "product_id": "P2", "employee_id": "E2"}


FIRST_LOAD = {}


@pytest.fixture(scope="module")
def first_load(spark, tmp_path_factory):
    """Folder of a warehouse loaded once; tests work on copies."""
    root = tmp_path_factory.mktemp("first") / "warehouse"
    warehouse = Warehouse(spark, str(root))
    loads.load_staging(
        warehouse, raw_sales(spark, "cash", {}, BOB), raw_sales(spark, "card", {"payment_id": "c1", "ship_mode": None})
    )
    FIRST_LOAD.update(loads.load_all(warehouse, DAY))
    return root


@pytest.fixture
def loaded(spark, first_load, tmp_path):
    root = tmp_path / "copy"
    shutil.copytree(first_load, root)
    return Warehouse(spark, str(root)), FIRST_LOAD


def log_rows(warehouse):
    return warehouse.read(LOG_TABLE).orderBy("log_id").collect()


def test_full_load_rerun_and_counts(loaded):
    warehouse, first = loaded
    assert first == {
        "bl_3nf.ce_ship_modes": 2,
        "bl_3nf.ce_returned": 2,
        "bl_3nf.ce_payments": 2,
        "bl_3nf.ce_locations": 2,
        "bl_3nf.ce_employees": 3,
        "bl_3nf.ce_products": 3,
        "bl_3nf.ce_customers_scd": 3,
        "bl_dm.dim_ship_modes": 1,
        "bl_dm.dim_returned": 1,
        "bl_dm.dim_payments": 1,
        "bl_dm.dim_locations": 1,
        "bl_dm.dim_employees": 2,
        "bl_dm.dim_products": 2,
        "bl_dm.dim_customers_scd": 2,
        "bl_dm.dim_time_day": 2,
    }
    files = {t: sorted(warehouse.read(t).inputFiles()) for t in first}
    assert set(loads.load_all(warehouse, NEXT).values()) == {0}
    # A load without changes writes nothing.
    assert {t: sorted(warehouse.read(t).inputFiles()) for t in first} == files
    outcome = validation.load_outcomes(warehouse, list(loads.dimension_ids())).collect()
    assert len(outcome) == 8 and {(r["status"], r["rows_affected"]) for r in outcome} == {("SUCCESS", 0)}
    for row in validation.dimension_counts(warehouse).collect():
        assert row["default_rows"] == 1 and row["total_rows"] == row["default_rows"] + row["business_rows"]
    assert [r["log_id"] for r in log_rows(warehouse)] == list(range(1, 32))
    assert validation.duplicate_keys(warehouse).count() == 0
    assert validation.active_versions(warehouse).count() == 0
    assert {r["table_name"]: r["row_count"] for r in validation.entity_counts(warehouse).collect()}["ce_products"] == 3
    # The layers label the unknown member differently, so it is the one row that does not reconcile.
    assert {tuple(r) for r in validation.reconcile_customers(warehouse).collect()} == {
        ("only_in_bl_3nf", 1),
        ("only_in_bl_dm", 1),
    }


def test_customer_history_end_to_end(loaded, sales):
    warehouse, _ = loaded
    corrections.set_source_segment(warehouse, "AA-10315", "SCD2_TEST_SEGMENT")
    dimension = DIMENSIONS[CUSTOMERS.name]
    assert loads.load_entity(warehouse, CUSTOMERS, NEXT) == 2
    assert loads.load_dimension(warehouse, dimension, NEXT) == 2
    history = validation.customer_history(warehouse, F.col("customer_src_id") == "AA-10315")
    assert {tuple(r) for r in version_summary(history).collect()} == {("BL_3NF", 2, 1, 1), ("BL_DM", 2, 1, 1)}
    rows = history.where("layer_name = 'BL_DM'").collect()
    versions = sorted((r["version_id"], r["start_dt"], str(r["end_dt"]), r["is_active"]) for r in rows)
    assert versions == [(1, DAY, str(DAY), "N"), (3, NEXT, "9999-12-31", "Y")]

    # Clean up by hand: drop the test version and reopen the first one.
    assert corrections.count_source_segment(warehouse, "AA-10315", "SCD2_TEST_SEGMENT") == 1
    corrections.take_back_version(warehouse, "AA-10315", "SCD2_TEST_SEGMENT", 1)
    corrections.set_source_segment(warehouse, "AA-10315", "Consumer", "SCD2_TEST_SEGMENT")
    assert corrections.count_source_segment(warehouse, "AA-10315", "SCD2_TEST_SEGMENT") == 0
    assert loads.load_entity(warehouse, CUSTOMERS, NEXT) == 0
    assert loads.load_dimension(warehouse, dimension, NEXT) == 0


def test_two_changes_on_one_day_fail_in_the_dimension(loaded):
    warehouse, _ = loaded
    staged = warehouse.read(loads.CASH_TABLE)
    for segment in ("One", "Two"):
        warehouse.replace(loads.CASH_TABLE, staged.withColumn("segment", F.lit(segment)))
        loads.forget_progress(warehouse)
        assert loads.load_entity(warehouse, CUSTOMERS, NEXT) == 4
        staged = warehouse.read(loads.CASH_TABLE)
    before = warehouse.read("bl_dm.dim_customers_scd").inputFiles()
    assert loads.load_dimension(warehouse, DIMENSIONS[CUSTOMERS.name], NEXT) is None
    assert sorted(warehouse.read("bl_dm.dim_customers_scd").inputFiles()) == sorted(before)
    last = log_rows(warehouse)[-1]
    assert (last["status"], last["rows_affected"], last["error_code"]) == ("ERROR", 0, "23505")
    assert "start_dt" in last["error_message"]


def test_later_batches_are_loaded_alone(warehouse, sales, monkeypatch):
    loads.load_staging(warehouse, sales("cash", {}, BOB), sales("card", {"payment_id": "c1"}))
    first = loads.load_all(warehouse, DAY)
    assert first["bl_3nf.ce_customers_scd"] == 3 and set(loads.load_all(warehouse, DAY).values()) == {0}
    # Nothing is read from staging as long as no batch is new.
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "read_after", lambda *_: pytest.fail("staging was read"))
        assert set(loads.load_all(warehouse, NEXT).values()) == {0}
    # A later batch with an older customer under a smaller name, a new one, and a product that is stored.
    later = [{"payment_id": "p8", "customer_name": "AAA"}, {"payment_id": "p9", "customer_id": "N-1", "product_id": "P2"}]
    loads.load_staging(warehouse, sales("cash", *later), sales("card", {"payment_id": "c9", "customer_name": "AA"}))
    read = []
    plain = Warehouse.read_after
    monkeypatch.setattr(Warehouse, "read_after", lambda self, table, batch: read.append(batch) or plain(self, table, batch))
    second = loads.load_all(warehouse, NEXT)
    assert set(read) == {1}
    changed = {table: n for table, n in second.items() if n}
    assert changed == {"bl_3nf.ce_customers_scd": 3, "bl_dm.dim_customers_scd": 3}
    versions = warehouse.read(CUSTOMERS.table).where("customer_id <> -1").orderBy("customer_id").collect()
    assert [(r["customer_src_id"], r["customer_name"], r["is_active"]) for r in versions] == [
        ("AA-10315", "Alex Avila", "N"), ("BB-1", "Bob", "Y"), ("AA-10315", "AAA", "Y"), ("N-1", "Alex Avila", "Y"),
    ]


def test_bad_card_file_leaves_both_sources_out(warehouse, sales):
    with pytest.raises(Exception, match="does not fit"):
        loads.load_staging(warehouse, sales("cash", {}), sales("card", {"sales": "x"}))
    assert not warehouse.exists(loads.CASH_TABLE) and not warehouse.exists(loads.CARD_TABLE)


def test_changed_key_that_closes_two_versions_is_an_error(loaded, sales):
    warehouse, _ = loaded
    stored = warehouse.read(CUSTOMERS.table)
    warehouse.append(CUSTOMERS.table, stored.where("customer_src_id = 'AA-10315'"))
    loads.load_staging(warehouse, sales("cash", {"payment_id": "p5", "customer_name": "AAA"}), sales("card", {}))
    before = sorted(warehouse.read(CUSTOMERS.table).inputFiles())
    with pytest.raises(CloseMismatch, match="AA-10315"):
        loads.load_entity(warehouse, CUSTOMERS, NEXT, raise_on_error=True)
    last = log_rows(warehouse)[-1]
    assert (last["status"], last["rows_affected"], last["error_code"]) == ("ERROR", 0, "P0001")
    assert sorted(warehouse.read(CUSTOMERS.table).inputFiles()) == before
    # The batch has not been noted as loaded.
    assert last_mark(warehouse, CUSTOMERS.table) == 1


def test_one_changed_customer_leaves_other_folders(loaded, sales):
    warehouse, _ = loaded
    before = {t: set(warehouse.read(t).inputFiles()) for t in (CUSTOMERS.table, "bl_dm.dim_customers_scd")}
    assert all(len(f) == 3 for f in before.values())
    loads.load_staging(warehouse, sales("cash", {"payment_id": "p5", "customer_name": "AAA"}), sales("card", {}))
    assert loads.load_entity(warehouse, CUSTOMERS, NEXT) == 2
    assert loads.load_dimension(warehouse, DIMENSIONS[CUSTOMERS.name], NEXT) == 2
    for table, files in before.items():
        assert len(files & set(warehouse.read(table).inputFiles())) == 2


def test_employee_with_two_names_fails_in_the_dimension_only(warehouse, sales):
    cash = sales("cash", {}, {"payment_id": "p2", "employee_name": "Rob"})
    loads.load_staging(warehouse, cash, sales("card", {}))
    loads.create_tables(warehouse)
    assert loads.load_entity(warehouse, ENTITIES["employees"], DAY) == 3
    spec = DIMENSIONS["employees"]
    assert loads.load_dimension(warehouse, spec, DAY) is None
    assert warehouse.count(spec.table) == 1
    with pytest.raises(Exception, match="unique employee_src_id"):
        loads.load_dimension(warehouse, spec, DAY, raise_on_error=True)


def test_older_releases_of_the_entity_load(warehouse, sales):
    loads.load_staging(warehouse, sales("cash", {}), sales("card", {"ship_mode": "Air"}))
    modes = ENTITIES["ship_modes"]
    assert loads.load_entity(warehouse, modes, DAY, "v1") == 3
    # The ids of the oldest release start at 1 every time, so new rows collide with stored ones.
    warehouse.append_batch(loads.CARD_TABLE, warehouse.read(loads.CARD_TABLE).withColumn("ship_mode", F.lit("Sea")), 2)
    assert loads.load_entity(warehouse, modes, DAY, "v1") is None
    assert log_rows(warehouse)[-1]["error_code"] == "23505"
    assert loads.load_entity(warehouse, modes, DAY, "v2") == 1
    assert loads.load_entity(warehouse, CUSTOMERS, DAY, "v2") == 2
    assert loads.load_entity(warehouse, CUSTOMERS, DAY, "v2") == 0
    warehouse.replace(loads.CASH_TABLE, warehouse.read(loads.CASH_TABLE).withColumn("segment", F.lit("Zoo")))
    assert loads.load_entity(warehouse, CUSTOMERS, NEXT, "v2") == 2


def test_missing_sources_are_logged_as_an_error(warehouse):
    assert loads.load_calendar(warehouse) is None
    entry = log_rows(warehouse)[0]
    assert (entry["procedure_name"], entry["status"], entry["rows_affected"]) == ("prc_load_dim_time_day", "ERROR", 0)
    assert entry["message"] == "Error while loading DIM_TIME_DAY."


def test_log_entry_fields(warehouse):
    write_log(warehouse, "prc_x", None, None, "SUCCESS", None)
    write_log(warehouse, "prc_x", "t", 5, "ERROR", "m", "P0001", "text")
    first, second = log_rows(warehouse)
    assert (first["log_id"], first["target_table"], first["rows_affected"]) == (1, None, None)
    assert tuple(second)[0] == 2 and tuple(second)[2:] == ("prc_x", "t", 5, "ERROR", "m", "P0001", "text")
    assert isinstance(second["log_datetime"], dt.datetime)
    with pytest.raises(ValueError):
        write_log(warehouse, "p" * 256, "t", 0, "SUCCESS", "m")


def test_command_line_job(spark, sales, tmp_path):
    import run_load
    from strataload.sources.csv import write_sales_csv

    write_sales_csv(sales("cash", {}, BOB), str(tmp_path / "cash"))
    write_sales_csv(sales("card", {"payment_id": "c1"}), str(tmp_path / "card"))
    place = ["--root", str(tmp_path / "w"), "--as-of", "2024-01-01"]
    first = run_load.main([*place, "--cash", str(tmp_path / "cash"), "--card", str(tmp_path / "card")])
    assert first["bl_dm.dim_customers_scd"] == 2
    assert set(run_load.main(place).values()) == {0}


def test_a_dimension_waits_for_its_own_entity_alone(warehouse, sales, monkeypatch):
    loads.load_staging(warehouse, sales("cash", {}), sales("card", {"payment_id": "c1"}))
    load_entity, load_dimension, published = loads.load_entity, loads.load_dimension, Event()
    waited = []

    def slow_entity(warehouse, spec, as_of, *rest, **options):
        if spec is CUSTOMERS:
            waited.append(published.wait(60))
        return load_entity(warehouse, spec, as_of, *rest, **options)

    def noted_dimension(warehouse, spec, as_of, *rest, **options):
        affected = load_dimension(warehouse, spec, as_of, *rest, **options)
        published.set()
        return affected

    monkeypatch.setattr(loads, "load_entity", slow_entity)
    monkeypatch.setattr(loads, "load_dimension", noted_dimension)
    assert None not in loads.load_all(warehouse, DAY).values()
    assert waited == [True]


def test_both_files_are_typed_and_added_side_by_side(warehouse, sales, monkeypatch):
    both_typed, both_added = Barrier(2, timeout=60), Barrier(2, timeout=60)
    typed_sales, append_batch = loads.typed_sales, Warehouse.append_batch

    def typed(*arguments):
        both_typed.wait()
        return typed_sales(*arguments)

    def added(*arguments):
        both_added.wait()
        return append_batch(*arguments)

    monkeypatch.setattr(loads, "typed_sales", typed)
    monkeypatch.setattr(Warehouse, "append_batch", added)
    loads.load_staging(warehouse, sales("cash", {}), sales("card", {"payment_id": "c1"}))
    assert warehouse.count(loads.CASH_TABLE) and warehouse.count(loads.CARD_TABLE)


def test_columns_of_many_values_are_staged_without_a_dictionary(warehouse, sales):
    rows = loads.typed_sales(sales("cash", {})).crossJoin(warehouse.spark.range(1000).select(F.lit(1)))
    warehouse.append_batch(loads.CASH_TABLE, rows.select(*warehouse.schemas[loads.CASH_TABLE].names), 1)
    for file in warehouse.read(loads.CASH_TABLE).inputFiles():
        group = pq.ParquetFile(urlparse(file).path).metadata.row_group(0)
        chunks = [group.column(i) for i in range(group.num_columns)]
        assert {c.compression for c in chunks} == {"ZSTD"}
        with_dictionary = {c.path_in_schema for c in chunks if c.has_dictionary_page}
        assert "country" in with_dictionary
        assert not with_dictionary & {"payment_id", "order_id", "customer_id", "customer_name", "product_id"}
