"""The registered queries: each takes a session and a folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import (
    BY_CUSTOMER,
    BY_CUSTOMER_AND_YEAR,
    BY_YEAR,
    BY_YEAR_AND_CATEGORY,
    CUSTOMERS,
    ORDER_FACT,
    ORDERS,
    PRODUCTS,
    PROFIT_INFO,
    Mart,
    build_mart,
    dimension_slices,
    order_fact,
    profit_by_customer,
    profit_by_customer_and_year,
    profit_by_year,
    profit_by_year_and_category,
    profit_info,
    profit_info_with_product,
    read_csv,
    read_json,
    read_workbooks,
    rollup_sql,
)
from ledgerloom.operators.conform import OnBadValue
from ledgerloom.paths import work_dir
from ledgerloom.tables import Table
from trial import shapes
from trial.files import write_csv, write_json_arrays, write_json_lines, write_workbooks

#: Rows of a hot product's slice in the trial.
HOT_PIECE_ROWS = 20
#: Order lines of a file that is read in ranges, some 200 MB, and the most bytes of a range.
RANGED_ROWS, RANGE_BYTES = 1_000_000, "32m"

Query = Callable[[SparkSession, str], DataFrame]


# source files


def product_names_with_quoting(products: DataFrame) -> DataFrame:
    """Names that need CSV quoting: a comma, quotes and a line break in each."""
    name = F.concat(F.col("`Product Name`"), F.lit(', 3.5" disk\n"boxed"'))
    return products.withColumn("Product Name", name)


def src_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "products-csv")
    write_csv(product_names_with_quoting(shapes.products_source(spark, sf_dir)), path)
    return read_csv(spark, path, PRODUCTS)


def src_products_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "products-csv-lines")
    write_csv(shapes.products_source(spark, sf_dir), path)
    return read_csv(spark, path, PRODUCTS, multi_line=False)


@contextmanager
def ranges(spark: SparkSession, least: int) -> Iterator[None]:
    """Lets Spark divide files into at least so many ranges, and large ones into more."""
    settings = {
        "spark.sql.files.minPartitionNum": str(least),
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.maxPartitionBytes": RANGE_BYTES,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def src_products_csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with quoted line breaks, each read by many tasks."""
    mart = Mart(spark, work_dir(spark, "products-csv-ranges"))
    products = product_names_with_quoting(shapes.products_source(spark, sf_dir))
    write_csv(products, f"{mart.data_dir}/files/Products.csv")
    with ranges(spark, 16):
        mart.write_products_raw(mart.read_products_csv())
    return mart.read_raw(PRODUCTS)


def src_orders_json_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one JSON array each, each read by many tasks."""
    mart = Mart(spark, work_dir(spark, "orders-json-ranges"))
    orders = shapes.orders_source(spark, sf_dir)
    write_json_arrays(orders, f"{mart.data_dir}/files/Orders.json", rows=RANGED_ROWS)
    with ranges(spark, 16):
        mart.write_orders_raw(mart.read_orders_json())
    return mart.read_raw(ORDERS)


def src_orders_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders-json-lines")
    write_json_lines(shapes.orders_source(spark, sf_dir), path)
    return read_json(spark, path, ORDERS, multi_line=False)


def src_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders-json")
    write_json_arrays(shapes.orders_source(spark, sf_dir), path)
    return read_json(spark, path, ORDERS)


def src_customers_xlsx(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "customers-xlsx")
    write_workbooks(shapes.customers_source(spark, sf_dir), path)
    return read_workbooks(spark, path, CUSTOMERS)


# stored tables


def stored_raw(table: Table, source: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = Mart(spark, work_dir(spark, "raw"))
        getattr(mart, f"write_{table.name}_raw")(source(spark, sf_dir))
        return mart.read_raw(table)

    return query


def stored_enriched(table: Table, source: Query, on_bad_value: OnBadValue = "fail") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = Mart(spark, work_dir(spark, "enriched"), on_bad_value=on_bad_value)
        getattr(mart, f"write_{table.name}_enriched")(source(spark, sf_dir))
        return getattr(mart, f"read_{table.name}_enriched")()

    return query


def stored_order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = Mart(spark, work_dir(spark, "fact"))
    mart.create_order_fact(
        customers_df=shapes.customers(spark, sf_dir),
        orders_df=shapes.orders(spark, sf_dir),
        products_df=shapes.products(spark, sf_dir),
    )
    return mart.read_order_fact()


def stored_profit_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = Mart(spark, work_dir(spark, "profit-info"))
    mart.create_profit_info(fact(spark, sf_dir))
    return mart.read_profit_info()


def mart_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow over source files derived from the tables; gives its profit_info."""
    data_dir = work_dir(spark, "mart")
    write_source_files(spark, sf_dir, data_dir)
    return build_mart(spark, data_dir).profit_info


def mart_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over files with one record per line, the orders' compressed."""
    data_dir = work_dir(spark, "mart-lines")
    write_csv(shapes.products_source(spark, sf_dir), f"{data_dir}/files/Products.csv")
    write_workbooks(shapes.customers_source(spark, sf_dir), f"{data_dir}/files/Customer.xlsx")
    write_json_lines(shapes.orders_source(spark, sf_dir), f"{data_dir}/files/Orders.json", "gzip")
    return build_mart(spark, data_dir, multi_line=False).profit_info


def write_source_files(spark: SparkSession, sf_dir: str, data_dir: str) -> None:
    write_csv(shapes.products_source(spark, sf_dir), f"{data_dir}/files/Products.csv")
    write_workbooks(shapes.customers_source(spark, sf_dir), f"{data_dir}/files/Customer.xlsx")
    write_json_arrays(shapes.orders_source(spark, sf_dir), f"{data_dir}/files/Orders.json", "gzip")


# facts


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fact(
        shapes.orders(spark, sf_dir), shapes.customers(spark, sf_dir), shapes.products(spark, sf_dir)
    )


def fact_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact with a third of its customers and a third of its products unknown."""
    return order_fact(
        shapes.orders(spark, sf_dir, gaps=True),
        shapes.customers(spark, sf_dir),
        shapes.products(spark, sf_dir),
    )


def order_fact_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fact(
        shapes.orders(spark, sf_dir),
        shapes.customers(spark, sf_dir),
        shapes.products_by_state(spark, sf_dir),
    )


def order_fact_hot_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact whose hot product is found and dealt over slices, small ones so that there are some."""
    products = shapes.products_with_hot_id(spark, sf_dir)
    path = work_dir(spark, "slices")
    dimension_slices(products, "product_id", HOT_PIECE_ROWS).write.parquet(path)
    return order_fact(
        shapes.orders(spark, sf_dir),
        shapes.customers(spark, sf_dir),
        products,
        product_slices=spark.read.parquet(path),
        piece_rows=HOT_PIECE_ROWS,
    )


# rollups


def over_gaps(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fact_with_gaps(spark, sf_dir))


def over_cells(build: Callable[[DataFrame], DataFrame]) -> Query:
    """The rollup over the stored cells of the fact with gaps, which is read once for them."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = Mart(spark, work_dir(spark, "cells"))
        mart.create_profit_cells(fact_with_gaps(spark, sf_dir))
        return build(mart.read_profit_cells())

    return query


def first_five(build: Callable[[DataFrame], DataFrame]) -> Query:
    return over_gaps(lambda fact: build(fact).limit(5))


def preview_order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of the stored fact, ordered by all of its columns."""
    return stored_order_fact(spark, sf_dir).orderBy(ORDER_FACT.names).limit(5)


QUERIES: dict[str, Query] = {
    "src_products_csv": src_products_csv,
    "src_orders_json": src_orders_json,
    "src_orders_json_lines": src_orders_json_lines,
    "src_products_csv_lines": src_products_csv_lines,
    "src_products_csv_ranges": src_products_csv_ranges,
    "src_orders_json_ranges": src_orders_json_ranges,
    "src_customers_xlsx": src_customers_xlsx,
    "raw_products": stored_raw(PRODUCTS, shapes.products_source),
    "raw_customers": stored_raw(CUSTOMERS, shapes.customers_source),
    "raw_orders": stored_raw(ORDERS, shapes.orders_source),
    "enriched_products": stored_enriched(PRODUCTS, shapes.products_source),
    "enriched_customers": stored_enriched(CUSTOMERS, shapes.customers_source),
    "enriched_orders": stored_enriched(ORDERS, shapes.orders_source),
    "enriched_products_lenient": stored_enriched(PRODUCTS, shapes.products_source_bad, "null"),
    "enriched_customers_lenient": stored_enriched(CUSTOMERS, shapes.customers_source_bad, "null"),
    "enriched_orders_lenient": stored_enriched(ORDERS, shapes.orders_source_bad, "null"),
    "order_fact": stored_order_fact,
    "order_fact_orphans": fact_with_gaps,
    "order_fact_fanout": order_fact_fanout,
    "order_fact_hot_product": order_fact_hot_product,
    "profit_info": stored_profit_info,
    "profit_info_nonnull": over_gaps(lambda f: profit_info_with_product(profit_info(f))),
    "profit_by_year": over_gaps(profit_by_year),
    "profit_by_year_category": over_gaps(profit_by_year_and_category),
    "profit_by_customer": over_gaps(profit_by_customer),
    "profit_by_customer_year": over_gaps(profit_by_customer_and_year),
    "profit_info_sql": over_gaps(lambda f: rollup_sql(f, PROFIT_INFO)),
    "profit_by_year_sql": over_gaps(lambda f: rollup_sql(f, BY_YEAR)),
    "profit_by_year_category_sql": over_gaps(lambda f: rollup_sql(f, BY_YEAR_AND_CATEGORY)),
    "profit_by_customer_sql": over_gaps(lambda f: rollup_sql(f, BY_CUSTOMER)),
    "profit_by_customer_year_sql": over_gaps(lambda f: rollup_sql(f, BY_CUSTOMER_AND_YEAR)),
    "profit_info_cells": over_cells(profit_info),
    "profit_by_year_cells": over_cells(profit_by_year),
    "profit_by_year_category_cells": over_cells(profit_by_year_and_category),
    "profit_by_customer_cells": over_cells(profit_by_customer),
    "profit_by_customer_year_cells": over_cells(profit_by_customer_and_year),
    "preview_order_fact": preview_order_fact,
    "preview_profit_info": first_five(lambda f: profit_info_with_product(profit_info(f))),
    "preview_years": first_five(profit_by_year),
    "preview_years_categories": first_five(profit_by_year_and_category),
    "preview_top_customers": first_five(profit_by_customer),
    "preview_top_customers_by_year": first_five(profit_by_customer_and_year),
    "mart_from_files": mart_from_files,
    "mart_from_lines": mart_from_lines,
}
