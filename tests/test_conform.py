from __future__ import annotations

import datetime

import pytest
from pyspark.sql import Observation

from ledgerloom import (
    CUSTOMERS,
    ORDERS,
    PRODUCTS,
    bad_value_counts,
    conform,
    watch_bad_values,
)

D = datetime.date


def source(spark, table, *records):
    names = table.source_schema.names
    values = [tuple(record.get(name) for name in names) for record in records]
    return spark.createDataFrame(values, table.source_schema)


def test_columns_are_renamed_typed_and_others_dropped(spark):
    from pyspark.sql import functions as F

    df = source(spark, PRODUCTS, {"Product ID": "P1", "Price Per Product": "12.50"})
    typed = conform(df.withColumn("extra", F.lit(1)), PRODUCTS)
    assert typed.schema == PRODUCTS.schema
    assert tuple(typed.first()) == ("P1", None, None, None, None, 12.5)


def test_missing_column_is_an_error_at_once(spark):
    df = spark.createDataFrame([("x",)], "product_id string")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        conform(df, PRODUCTS)


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("5/9/2016", D(2016, 9, 5)),
        ("05/09/2016", D(2016, 9, 5)),
        ("29/2/2016", D(2016, 2, 29)),
        (None, None),
    ],
)
def test_dates_are_day_first(spark, written, expected):
    df = source(spark, ORDERS, {"Order Date": written})
    assert conform(df, ORDERS).first()["order_date"] == expected
    assert conform(df, ORDERS, "null").first()["order_date"] == expected


@pytest.mark.parametrize("written", ["1/13/2016", "31/2/2016", "2016-08-21", "5/9/16", ""])
def test_bad_date(spark, written):
    df = source(spark, ORDERS, {"Order Date": written, "Order ID": "O1"})
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|INCONSISTENT_BEHAVIOR|DateTime"):
        conform(df, ORDERS).collect()
    row = conform(df, ORDERS, "null").first()
    assert (row["order_id"], row["order_date"]) == ("O1", None)


def test_dates_that_are_dates_already_pass_through(spark):
    from pyspark.sql import functions as F

    df = source(spark, ORDERS, {"Order ID": "O1"}).withColumn("Order Date", F.lit(D(2016, 1, 2)))
    assert conform(df, ORDERS).first()["order_date"] == D(2016, 1, 2)


@pytest.mark.parametrize(("written", "expected"), [("10001", 10001), ("01234", 1234), (" 7 ", 7)])
def test_postal_code(spark, written, expected):
    df = source(spark, CUSTOMERS, {"Postal Code": written})
    assert conform(df, CUSTOMERS).first()["postal_code"] == expected


@pytest.mark.parametrize("written", ["", "10001.0", "K1A 0B1", "12345-6789"])
def test_bad_postal_code(spark, written):
    df = source(spark, CUSTOMERS, {"Postal Code": written})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, CUSTOMERS).collect()
    assert conform(df, CUSTOMERS, "null").first()["postal_code"] is None


def test_bad_price(spark):
    df = source(spark, PRODUCTS, {"Price Per Product": "abc"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, PRODUCTS).collect()
    assert conform(df, PRODUCTS, "null").first()["price_per_product"] is None


def test_bad_values_are_counted_per_column(spark):
    df = source(
        spark,
        ORDERS,
        {"Order Date": "1/13/2016", "Ship Date": "1/1/2016"},
        {"Order Date": "x", "Ship Date": "y"},
        {"Order Date": None, "Ship Date": "2/1/2016"},
    )
    assert bad_value_counts(df, ORDERS).first().asDict() == {"order_date": 2, "ship_date": 1}


def test_bad_values_are_counted_while_writing(spark, tmp_path):
    df = source(spark, CUSTOMERS, {"Postal Code": "x"}, {"Postal Code": "1"}, {})
    counts = Observation("bad customers")
    watched = watch_bad_values(df, CUSTOMERS, counts)
    conform(watched, CUSTOMERS, "null").write.parquet(str(tmp_path / "t"))
    assert counts.get == {"postal_code": 1}
