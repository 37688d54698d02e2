"""Retail profit mart on Spark: files to raw, raw to typed, typed to facts and rollups."""

from ledgerloom.layers import load_table, store_table, table_path
from ledgerloom.operators.conform import bad_value_counts, conform, watch_bad_values
from ledgerloom.operators.fact import dimension_slices, order_fact, repeated_keys
from ledgerloom.operators.rollups import (
    BY_CUSTOMER,
    BY_CUSTOMER_AND_YEAR,
    BY_YEAR,
    BY_YEAR_AND_CATEGORY,
    PROFIT_INFO,
    profit_by_customer,
    profit_by_customer_and_year,
    profit_by_year,
    profit_by_year_and_category,
    profit_cells,
    profit_info,
    profit_info_with_product,
    rollup,
    rollup_sql,
)
from ledgerloom.plans.mart import Mart, build_mart
from ledgerloom.session import build_session
from ledgerloom.sources import empty_table, read_csv, read_json, read_workbooks
from ledgerloom.tables import (
    CUSTOMERS,
    ORDER_FACT,
    ORDERS,
    PRODUCTS,
    PROFIT_CELLS_SCHEMA,
    PROFIT_INFO_SCHEMA,
)

__all__ = [
    "BY_CUSTOMER",
    "BY_CUSTOMER_AND_YEAR",
    "BY_YEAR",
    "BY_YEAR_AND_CATEGORY",
    "CUSTOMERS",
    "Mart",
    "ORDERS",
    "ORDER_FACT",
    "PRODUCTS",
    "PROFIT_CELLS_SCHEMA",
    "PROFIT_INFO",
    "PROFIT_INFO_SCHEMA",
    "bad_value_counts",
    "build_mart",
    "build_session",
    "conform",
    "empty_table",
    "dimension_slices",
    "load_table",
    "order_fact",
    "profit_by_customer",
    "profit_by_customer_and_year",
    "profit_by_year",
    "profit_by_year_and_category",
    "profit_cells",
    "profit_info",
    "profit_info_with_product",
    "read_csv",
    "read_json",
    "read_workbooks",
    "repeated_keys",
    "rollup",
    "rollup_sql",
    "store_table",
    "table_path",
    "watch_bad_values",
]
