"""Declarations of the mart's tables.

A source table is stated once, as a list of columns with their name and type in
the file and in the typed layer; both schemas are derived from that list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()


@dataclass(frozen=True)
class Column:
    """One column: its name and type in the source, then in the typed layer."""

    source: str
    source_type: T.DataType
    name: str
    type: T.DataType
    date_format: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]

    @property
    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.source, c.source_type) for c in self.columns])

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])


# Column names, types and the date pattern are part of the mart's contract.

PRODUCTS = Table(
    "products",
    (
        Column("Product ID", STRING, "product_id", STRING),
        Column("Category", STRING, "category", STRING),
        Column("Sub-Category", STRING, "sub_category", STRING),
        Column("Product Name", STRING, "product_name", STRING),
        Column("State", STRING, "state", STRING),
        Column("Price Per Product", STRING, "price_per_product", DOUBLE),
    ),
)

CUSTOMERS = Table(
    "customers",
    (
        Column("Customer ID", STRING, "customer_id", STRING),
        Column("Customer Name", STRING, "customer_name", STRING),
        Column("email", STRING, "email", STRING),
        Column("phone", STRING, "phone", STRING),
        Column("address", STRING, "address", STRING),
        Column("Segment", STRING, "segment", STRING),
        Column("Country", STRING, "country", STRING),
        Column("City", STRING, "city", STRING),
        Column("State", STRING, "state", STRING),
        Column("Postal Code", STRING, "postal_code", INT),
        Column("Region", STRING, "region", STRING),
    ),
)

ORDERS = Table(
    "orders",
    (
        Column("Row ID", INT, "row_id", INT),
        Column("Order ID", STRING, "order_id", STRING),
        Column("Order Date", STRING, "order_date", DATE, "d/M/yyyy"),
        Column("Ship Date", STRING, "ship_date", DATE, "d/M/yyyy"),
        Column("Ship Mode", STRING, "ship_mode", STRING),
        Column("Customer ID", STRING, "customer_id", STRING),
        Column("Product ID", STRING, "product_id", STRING),
        Column("Quantity", INT, "quantity", INT),
        Column("Price", DOUBLE, "price", DOUBLE),
        Column("Discount", DOUBLE, "discount", DOUBLE),
        Column("Profit", DOUBLE, "profit", DOUBLE),
    ),
)

ORDER_FACT = T.StructType(
    [
        T.StructField("order_id", STRING),
        T.StructField("order_date", DATE),
        T.StructField("ship_date", DATE),
        T.StructField("ship_mode", STRING),
        T.StructField("quantity", INT),
        T.StructField("price", DOUBLE),
        T.StructField("discount", DOUBLE),
        T.StructField("profit", DOUBLE),
        T.StructField("customer_id", STRING),
        T.StructField("customer_name", STRING),
        T.StructField("country", STRING),
        T.StructField("product_id", STRING),
        T.StructField("category", STRING),
        T.StructField("sub_category", STRING),
    ]
)

PROFIT_INFO_SCHEMA = T.StructType(
    [
        T.StructField("year", INT),
        T.StructField("product_category", STRING),
        T.StructField("product_sub_category", STRING),
        T.StructField("customer", STRING),
        T.StructField("total_profit", DOUBLE),
        T.StructField("order_count", LONG),
    ]
)

PROFIT_CELLS_SCHEMA = T.StructType(
    [
        *PROFIT_INFO_SCHEMA[:4],
        T.StructField("order_count", LONG),
        T.StructField("profit_low", LONG),
        T.StructField("profit_middle", LONG),
        T.StructField("profit_high", LONG),
        T.StructField("profit_millionths", LONG),
        T.StructField("profit_hard", LONG),
        T.StructField("profit_decimals", T.DecimalType(38, 12)),
        T.StructField("profit_lost", LONG),
        T.StructField("profit_doubles", DOUBLE),
    ]
)
