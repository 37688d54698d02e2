"""Shared session and small tables."""

from __future__ import annotations

import datetime

import pytest

from ledgerloom import CUSTOMERS, ORDERS, PRODUCTS, build_session, order_fact
from ledgerloom.paths import clear_scratch

D = datetime.date


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def data_dir(tmp_path):
    (tmp_path / "files").mkdir()
    return str(tmp_path)


# An order of two lines, one of them at a loss and of a product listed twice; two profits
# that tie; a line without a customer; namesakes; a customer without orders.
ORDER_ROWS = [
    (11, "A-71", D(2019, 2, 27), D(2019, 3, 2), "Drone", "K20", "P-lamp", 4, 18.25, 0.05, 6.4),
    (12, "A-71", D(2019, 2, 27), D(2019, 3, 4), "Courier", "K20", "P-rope", 1, 9.5, 0.0, -2.15),
    (13, "B-08", D(2020, 11, 30), D(2020, 12, 1), "Courier", "K31", "P-lamp", 2, 36.5, 0.15, 6.4),
    (14, "C-55", D(2020, 1, 9), D(2020, 1, 20), "Barge", None, "P-kiln", 1, 820.0, 0.3, 91.75),
]
CUSTOMER_ROWS = [
    ("K20", "Ottoline Marsh", "om@marsh.test", None, "4 Weir Lane", "Guild", "Eire", "Sligo", "SO", 4107, "Coast"),
    ("K31", "Ottoline Marsh", None, "+353 71 0", "9 Fen Row", "Trade", "Eire", "Ennis", "CE", 5520, "Inland"),
    ("K42", "Bram Okafor", "bram@okafor.test", None, None, "Guild", "Ghana", "Tema", "GA", 3, "Coast"),
]
PRODUCT_ROWS = [
    ("P-lamp", "Lighting", "Lanterns", "Storm lantern", "OR", 22.0),
    ("P-rope", "Rigging", "Cordage", "Hemp rope", "ME", 3.5),
    ("P-rope", "Rigging", "Cordage", "Hemp rope", "VT", 3.75),
    ("P-kiln", "Pottery", "Kilns", "Raku kiln", "NM", 640.0),
]


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ORDER_ROWS, ORDERS.schema)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS.schema)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCT_ROWS, PRODUCTS.schema)


@pytest.fixture
def fact(orders, customers, products):
    return order_fact(orders, customers, products)


def rows(df):
    """Rows in result order."""
    return [tuple(r) for r in df.collect()]


def bag(df):
    """Rows in a fixed order, for frames without one."""
    return sorted(rows(df), key=repr)
