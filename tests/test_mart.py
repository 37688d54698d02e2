from __future__ import annotations

import json
import logging
import os

import pytest

from ledgerloom import (
    CUSTOMERS,
    ORDER_FACT,
    ORDERS,
    PRODUCTS,
    PROFIT_INFO_SCHEMA,
    Mart,
    build_mart,
    profit_by_customer,
    profit_by_customer_and_year,
    profit_by_year,
    profit_by_year_and_category,
    profit_info,
)
from tests.conftest import CUSTOMER_ROWS, ORDER_ROWS, PRODUCT_ROWS, bag, rows
from tests.test_rollups import EXPECTED
from trial.files import workbook

logging.getLogger("ledgerloom").setLevel(logging.CRITICAL)


def write_files(data_dir, customers=CUSTOMER_ROWS):
    """The shared tables as the three source files."""
    files = os.path.join(data_dir, "files")
    names = PRODUCTS.source_schema.names
    with open(f"{files}/Products.csv", "w") as f:
        f.write(",".join(names) + "\n")
        f.writelines(",".join(str(v) for v in row) + "\n" for row in PRODUCT_ROWS)
    with open(f"{files}/Orders.json", "w") as f:
        day = lambda d: f"{d.day}/{d.month}/{d.year}"
        records = [(*r[:2], day(r[2]), day(r[3]), *r[4:]) for r in ORDER_ROWS]
        json.dump([dict(zip(ORDERS.source_schema.names, r)) for r in records], f, indent=1)
    with open(f"{files}/Customer.xlsx", "wb") as f:
        texts = [tuple(None if v is None else str(v) for v in row) for row in customers]
        f.write(workbook(CUSTOMERS.source_schema.names, texts))


def test_files_to_rollups(spark, data_dir):
    write_files(data_dir)
    tables = build_mart(spark, data_dir)
    assert tables.order_fact.schema == ORDER_FACT
    assert tables.profit_info.schema == PROFIT_INFO_SCHEMA
    assert bag(tables.profit_info) == sorted(EXPECTED[profit_info], key=repr)
    assert rows(tables.profit_by_year) == EXPECTED[profit_by_year]
    assert rows(tables.profit_by_year_and_category) == EXPECTED[profit_by_year_and_category]
    assert rows(tables.profit_by_customer) == EXPECTED[profit_by_customer]
    assert rows(tables.profit_by_customer_and_year) == EXPECTED[profit_by_customer_and_year]

    mart = Mart(spark, data_dir)
    assert bag(mart.read_orders_enriched()) == bag(spark.createDataFrame(ORDER_ROWS, ORDERS.schema))
    assert bag(mart.read_customers_enriched()) == sorted(CUSTOMER_ROWS, key=repr)
    assert bag(mart.read_products_enriched()) == sorted(PRODUCT_ROWS, key=repr)
    assert mart.read_raw(PRODUCTS).first()["Price Per Product"] == "22.0"
    for layer, names in {
        "raw": "customers orders products",
        "enriched": "customers order_fact orders products",
        "aggregated": "profit_cells profit_info",
    }.items():
        assert sorted(os.listdir(f"{data_dir}/{layer}")) == [f"{n}.parquet" for n in names.split()]


def test_building_again_replaces_every_table(spark, data_dir):
    write_files(data_dir)
    build_mart(spark, data_dir)
    assert build_mart(spark, data_dir).order_fact.count() == 5


def test_files_with_one_record_per_line(spark, data_dir):
    write_files(data_dir)
    path = f"{data_dir}/files/Orders.json"
    with open(path) as f:
        records = json.load(f)
    with open(path, "w") as f:
        f.writelines(json.dumps(record) + "\n" for record in records)
    tables = build_mart(spark, data_dir, multi_line=False)
    assert bag(tables.profit_info) == sorted(EXPECTED[profit_info], key=repr)


def test_stored_profit_info_is_sorted(spark, data_dir, fact):
    mart = Mart(spark, data_dir)
    mart.create_profit_info(fact)
    assert rows(mart.read_profit_info().coalesce(1)) == EXPECTED[profit_info]


BAD_CUSTOMER = ("K31", "Ottoline Marsh", *[None] * 7, "K1A 0B1", "Inland")


def test_bad_value_stops_the_build(spark, data_dir):
    write_files(data_dir, [CUSTOMER_ROWS[0], BAD_CUSTOMER])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build_mart(spark, data_dir)
    assert not os.path.exists(f"{data_dir}/enriched/order_fact.parquet")


def test_bad_value_can_become_null(spark, data_dir):
    write_files(data_dir, [CUSTOMER_ROWS[0], BAD_CUSTOMER])
    tables = build_mart(spark, data_dir, on_bad_value="null")
    assert rows(tables.profit_by_customer) == EXPECTED[profit_by_customer]
    customers = Mart(spark, data_dir).read_customers_enriched()
    assert {r.customer_id: r.postal_code for r in customers.collect()} == {
        "K20": 4107, "K31": None,
    }


@pytest.mark.parametrize(
    ("codes", "count"), [(["K1A 0B1", "1", None, "x"], 2), (["1"], 0), ([], 0)]
)
def test_bad_values_that_became_null_are_reported(spark, data_dir, codes, count):
    schema = CUSTOMERS.source_schema
    values = [tuple(code if n == "Postal Code" else n for n in schema.names) for code in codes]
    mart = Mart(spark, data_dir, on_bad_value="null")
    mart.write_customers_enriched(spark.createDataFrame(values, schema))
    assert mart.bad_values == {"customers": {"postal_code": count}}


def cut_orders(data_dir):
    """The shared orders' file, cut inside its third object, with a quantity that is text."""
    write_files(data_dir)
    path = f"{data_dir}/files/Orders.json"
    with open(path) as f:
        text = f.read().replace('"Quantity": 4', '"Quantity": "four"')
    return path, text


def test_a_cut_document_stops_the_build(spark, data_dir):
    path, text = cut_orders(data_dir)
    with open(path, "w") as f:
        f.write(text[: text.index("B-08")])
    with pytest.raises(Exception, match="malformed record"):
        build_mart(spark, data_dir)
    assert not os.path.exists(f"{data_dir}/raw/orders.parquet")


def test_a_value_of_the_wrong_type_stops_the_build(spark, data_dir):
    path, text = cut_orders(data_dir)
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="malformed record"):
        build_mart(spark, data_dir)


@pytest.mark.parametrize("options", [{"on_bad_value": "null"}, {"policy": "lenient"}])
@pytest.mark.parametrize("split", [True, False])
def test_malformed_records_are_counted_where_they_may_be_null(spark, data_dir, options, split):
    path, text = cut_orders(data_dir)
    mart = Mart(spark, data_dir, **options, split=split)
    # Spark's own reader counts every object of an array with a malformed one, and makes a
    # document that is cut one record. In ranges each malformed object counts once.
    whole, cut = ((4, 1), (3, 2)) if split else ((4, 4), (1, 1))
    for content, (records, bad) in ((text, whole), (text[: text.index("B-08")], cut)):
        with open(path, "w") as f:
            f.write(content)
        assert mart.write_orders_raw(mart.read_orders_json()) is True
        assert mart.read_raw(ORDERS).count() == records
        assert mart.bad_records == {"orders": bad}
    os.remove(path)
    if options.get("policy"):
        assert mart.write_orders_raw(mart.read_orders_json()) is True


def test_malformed_lines_are_counted_one_by_one(spark, data_dir):
    path, text = cut_orders(data_dir)
    lines = [json.dumps(record) for record in json.loads(text)]
    with open(path, "w") as f:
        f.write("\n".join([*lines, lines[1][:40]]) + "\n")
    mart = Mart(spark, data_dir, on_bad_value="null", multi_line=False)
    mart.write_orders_raw(mart.read_orders_json())
    assert mart.read_raw(ORDERS).count() == 5
    assert mart.bad_records == {"orders": 2}


def test_missing_source_stops_the_build(spark, data_dir):
    write_files(data_dir)
    os.remove(f"{data_dir}/files/Customer.xlsx")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        build_mart(spark, data_dir)


# the older contract


@pytest.fixture
def lenient(spark, data_dir):
    return Mart(spark, data_dir, policy="lenient")


def test_lenient_readers_of_missing_data_are_empty_and_typed(lenient):
    expected = {
        "read_products_csv": PRODUCTS.source_schema,
        "read_customers_excel": CUSTOMERS.source_schema,
        "read_orders_json": ORDERS.source_schema,
        "read_products_enriched": PRODUCTS.schema,
        "read_customers_enriched": CUSTOMERS.schema,
        "read_orders_enriched": ORDERS.schema,
        "read_order_fact": ORDER_FACT,
        "read_profit_info": PROFIT_INFO_SCHEMA,
    }
    for name, schema in expected.items():
        df = getattr(lenient, name)()
        assert (df.schema, df.count()) == (schema, 0), name


@pytest.mark.parametrize("table", [PRODUCTS, CUSTOMERS, ORDERS], ids=lambda t: t.name)
def test_lenient_writers(spark, lenient, table):
    any_frame = spark.createDataFrame([], "a string, b string")
    assert getattr(lenient, f"write_{table.name}_raw")(any_frame) is True
    assert getattr(lenient, f"write_{table.name}_enriched")(any_frame) is False
    whole = spark.createDataFrame([], table.source_schema)
    assert getattr(lenient, f"write_{table.name}_enriched")(whole) is True
    assert getattr(lenient, f"read_{table.name}_enriched")().schema == table.schema


def test_lenient_fact_and_aggregate(spark, lenient, orders, customers, products, fact):
    assert lenient.create_order_fact(customers, orders, products) is True
    assert lenient.create_profit_info(lenient.read_order_fact()) is True
    assert lenient.read_profit_info().count() == 4
    wrong = spark.createDataFrame([], "col1 string")
    assert lenient.create_order_fact(wrong, orders, products) is False
    assert lenient.create_profit_info(wrong) is False
    assert lenient.read_order_fact().count() == 5


def test_lenient_rollups(spark, lenient):
    wrong = spark.createDataFrame([], "col1 string")
    for name in ("year", "year_and_category", "customer", "customer_and_year"):
        assert getattr(lenient, f"profit_by_{name}")(wrong) is None


def test_strict_rollup_raises(spark, data_dir):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        Mart(spark, data_dir).profit_by_year(spark.createDataFrame([], "col1 string"))
