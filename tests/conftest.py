import datetime as dt
import os
import sys
from functools import partial

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataload.session import local_session  # noqa: E402
from strataload.sources.schemas import CARD_COLUMNS, CASH_COLUMNS, raw_schema  # noqa: E402
from strataload.sources.warehouse import Warehouse  # noqa: E402

DAY = dt.date(2024, 1, 1)

SALE = {
    "payment_id": "p1",
    "order_id": "o1",
    "order_date": "2024-01-05",
    "ship_date": "2024-01-06",
    "ship_mode": "Second Class",
    "customer_id": "AA-10315",
    "customer_name": "Alex Avila",
    "segment": "Consumer",
    "country": "US",
    "city": "Austin",
    "state": "Texas",
    "postal_code": "01234",
    "region": "South",
    "product_id": "P1",
    "category": "Furniture",
    "sub_category": "Chairs",
    "product_name": "Chair",
    "sales": "10.5",
    "quantity": "2",
    "discount": "0.1",
    "profit": "-3.1234",
    "returned": "Yes",
    "employee_name": "Bob",
    "employee_id": "E1",
    "payment_type": "Cash",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def raw_sales(spark, source, *changes):
    """Raw sales rows of one source system, from the differences to a standard row."""
    names = CASH_COLUMNS if source == "cash" else CARD_COLUMNS
    rows = [tuple({**SALE, **change}[n] for n in names) for change in changes]
    return spark.createDataFrame(rows, raw_schema(names))


@pytest.fixture
def sales(spark):
    return partial(raw_sales, spark)


@pytest.fixture
def frame(spark):
    """A frame from a DDL schema and rows."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build
