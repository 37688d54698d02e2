"""The registered queries as SQL over the same tables, for another engine."""

from __future__ import annotations

PRODUCTS = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS sub_category,
       p_name AS product_name, CAST(NULL AS VARCHAR) AS state,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price
FROM part"""

CUSTOMERS = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
       c_mktsegment AS segment, n_name AS country, r_name AS region,
       c_custkey % 100000 AS postal_code
FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""

PROFIT = """CAST(l_extendedprice AS DECIMAL(12,2))
       * (CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))"""


def _orders(customer_id: str, product_id: str) -> str:
    return f"""
SELECT l_linenumber AS row_id, CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
       o_orderpriority AS ship_mode, {customer_id} AS customer_id, {product_id} AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price, l_discount AS discount,
       {PROFIT} AS profit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


ORDERS = _orders("CAST(o_custkey AS VARCHAR)", "CAST(l_partkey AS VARCHAR)")
ORDERS_WITH_GAPS = _orders(
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END",
    "CASE WHEN l_returnflag = 'R' THEN 'RET-' ELSE '' END || CAST(l_partkey AS VARCHAR)",
)
PRODUCTS_BY_STATE = f"SELECT p.* FROM ({PRODUCTS}) p, unnest(['NY', 'CA'])"
PRODUCTS_WITH_HOT_ID = f"""{PRODUCTS}
UNION ALL
SELECT '0', category, sub_category, product_name, state, price FROM ({PRODUCTS}) listed
WHERE category = 'PROMO'"""


def _fact(orders: str = ORDERS, products: str = PRODUCTS) -> str:
    return f"""
SELECT o.order_id, o.order_date, o.ship_date, o.ship_mode, o.quantity, o.price, o.discount,
       CAST(round(o.profit, 2) AS DOUBLE) AS profit,
       c.customer_id, c.customer_name, c.country, p.product_id, p.category, p.sub_category
FROM ({orders}) o
LEFT JOIN ({CUSTOMERS}) c ON o.customer_id = c.customer_id
LEFT JOIN ({products}) p ON o.product_id = p.product_id"""


YEAR = "CAST(year(order_date) AS INTEGER)"
# The fact's profit is in whole cents, so decimals give the exact total to compare with.
TOTAL_PROFIT = "CAST(sum(CAST(profit AS DECIMAL(18,2))) AS DOUBLE) AS total_profit"
GAPS = _fact(ORDERS_WITH_GAPS)


def _profit_info(fact: str) -> str:
    return f"""
SELECT {YEAR} AS year, category AS product_category, sub_category AS product_sub_category,
       customer_name AS customer, {TOTAL_PROFIT},
       count(order_id) AS order_count
FROM ({fact}) f GROUP BY 1, 2, 3, 4"""


PROFIT_INFO_NONNULL = f"""
SELECT * FROM ({_profit_info(GAPS)}) i
WHERE coalesce(product_category, product_sub_category) IS NOT NULL"""
BY_YEAR = f"SELECT {YEAR} AS year, {TOTAL_PROFIT} FROM ({GAPS}) f GROUP BY 1"
BY_YEAR_AND_CATEGORY = f"""
SELECT {YEAR} AS year, category AS product_category, {TOTAL_PROFIT}
FROM ({GAPS}) f WHERE category IS NOT NULL GROUP BY 1, 2"""
BY_CUSTOMER = f"""
SELECT customer_name AS customer, {TOTAL_PROFIT} FROM ({GAPS}) f GROUP BY 1"""
BY_CUSTOMER_AND_YEAR = f"""
SELECT {YEAR} AS year, customer_name AS customer, {TOTAL_PROFIT}
FROM ({GAPS}) f GROUP BY 1, 2"""


def _products_source(name: str = "product_name") -> str:
    return f"""
SELECT product_id AS "Product ID", category AS "Category", sub_category AS "Sub-Category",
       {name} AS "Product Name", state AS "State",
       CAST(price AS VARCHAR) AS "Price Per Product"
FROM ({PRODUCTS}) p"""


CUSTOMERS_SOURCE = f"""
SELECT customer_id AS "Customer ID", customer_name AS "Customer Name",
       CAST(NULL AS VARCHAR) AS "email", CAST(NULL AS VARCHAR) AS "phone",
       CAST(NULL AS VARCHAR) AS "address", segment AS "Segment", country AS "Country",
       CAST(NULL AS VARCHAR) AS "City", CAST(NULL AS VARCHAR) AS "State",
       lpad(CAST(postal_code AS VARCHAR), 5, '0') AS "Postal Code", region AS "Region"
FROM ({CUSTOMERS}) c"""

ORDERS_SOURCE = f"""
SELECT row_id AS "Row ID", order_id AS "Order ID",
       strftime(order_date, '%-d/%-m/%Y') AS "Order Date",
       strftime(ship_date, '%-d/%-m/%Y') AS "Ship Date", ship_mode AS "Ship Mode",
       customer_id AS "Customer ID", product_id AS "Product ID", quantity AS "Quantity",
       price AS "Price", discount AS "Discount", CAST(profit AS DOUBLE) AS "Profit"
FROM ({ORDERS}) o"""

ORACLES: dict[str, str] = {
    "src_products_csv": _products_source("product_name || ', 3.5\" disk' || chr(10) || '\"boxed\"'"),
    "src_products_csv_ranges": _products_source("product_name || ', 3.5\" disk' || chr(10) || '\"boxed\"'"),
    "src_orders_json": ORDERS_SOURCE,
    "src_orders_json_ranges": ORDERS_SOURCE,
    "src_orders_json_lines": ORDERS_SOURCE,
    "src_products_csv_lines": _products_source(),
    "src_customers_xlsx": CUSTOMERS_SOURCE,
    "raw_products": _products_source(),
    "raw_customers": CUSTOMERS_SOURCE,
    "raw_orders": ORDERS_SOURCE,
    "enriched_products": f"""
SELECT product_id, category, sub_category, product_name, state,
       CAST(price AS DOUBLE) AS price_per_product
FROM ({PRODUCTS}) p""",
    "enriched_customers": f"""
SELECT customer_id, customer_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
       CAST(NULL AS VARCHAR) AS address, segment, country, CAST(NULL AS VARCHAR) AS city,
       CAST(NULL AS VARCHAR) AS state, CAST(postal_code AS INTEGER) AS postal_code, region
FROM ({CUSTOMERS}) c""",
    "enriched_orders": f"SELECT * REPLACE (CAST(profit AS DOUBLE) AS profit) FROM ({ORDERS}) o",
    "enriched_products_lenient": f"""
SELECT product_id, category, sub_category, product_name, state,
       CASE WHEN CAST(product_id AS BIGINT) % 7 <> 0 THEN CAST(price AS DOUBLE) END AS price_per_product
FROM ({PRODUCTS}) p""",
    "enriched_customers_lenient": f"""
SELECT customer_id, customer_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
       CAST(NULL AS VARCHAR) AS address, segment, country, CAST(NULL AS VARCHAR) AS city,
       CAST(NULL AS VARCHAR) AS state,
       CASE WHEN CAST(customer_id AS BIGINT) % 5 <> 0 THEN CAST(postal_code AS INTEGER) END AS postal_code,
       region
FROM ({CUSTOMERS}) c""",
    "enriched_orders_lenient": f"""
SELECT * REPLACE (
  CAST(profit AS DOUBLE) AS profit,
  CASE WHEN CAST(order_id AS BIGINT) % 11 <> 0 THEN order_date END AS order_date,
  CASE WHEN CAST(order_id AS BIGINT) % 13 <> 0 THEN ship_date END AS ship_date)
FROM ({ORDERS}) o""",
    "order_fact": _fact(),
    "order_fact_orphans": GAPS,
    "order_fact_fanout": _fact(products=PRODUCTS_BY_STATE),
    "order_fact_hot_product": _fact(products=PRODUCTS_WITH_HOT_ID),
    "profit_info": _profit_info(_fact()),
    "profit_info_nonnull": PROFIT_INFO_NONNULL,
    "profit_by_year": BY_YEAR,
    "profit_by_year_category": BY_YEAR_AND_CATEGORY,
    "profit_by_customer": BY_CUSTOMER,
    "profit_by_customer_year": BY_CUSTOMER_AND_YEAR,
    "profit_by_customer_year_sql": BY_CUSTOMER_AND_YEAR,
    "profit_info_sql": _profit_info(GAPS),
    "profit_by_year_sql": BY_YEAR,
    "profit_by_year_category_sql": BY_YEAR_AND_CATEGORY,
    "profit_by_customer_sql": BY_CUSTOMER,
    "profit_info_cells": _profit_info(GAPS),
    "profit_by_year_cells": BY_YEAR,
    "profit_by_year_category_cells": BY_YEAR_AND_CATEGORY,
    "profit_by_customer_cells": BY_CUSTOMER,
    "profit_by_customer_year_cells": BY_CUSTOMER_AND_YEAR,
    "preview_order_fact": f"""{_fact()}
ORDER BY order_id NULLS FIRST, order_date NULLS FIRST, ship_date NULLS FIRST,
         ship_mode NULLS FIRST, quantity NULLS FIRST, price NULLS FIRST, discount NULLS FIRST,
         profit NULLS FIRST, customer_id NULLS FIRST, customer_name NULLS FIRST,
         country NULLS FIRST, product_id NULLS FIRST, category NULLS FIRST,
         sub_category NULLS FIRST LIMIT 5""",
    "preview_profit_info": f"""{PROFIT_INFO_NONNULL}
ORDER BY year DESC NULLS LAST, product_category NULLS FIRST,
         product_sub_category NULLS FIRST, customer NULLS FIRST LIMIT 5""",
    "preview_years": f"{BY_YEAR} ORDER BY year DESC NULLS LAST LIMIT 5",
    "preview_years_categories": f"""{BY_YEAR_AND_CATEGORY}
ORDER BY year DESC NULLS LAST, product_category NULLS FIRST LIMIT 5""",
    "preview_top_customers": f"""{BY_CUSTOMER}
ORDER BY total_profit DESC NULLS LAST, customer NULLS FIRST LIMIT 5""",
    "preview_top_customers_by_year": f"""{BY_CUSTOMER_AND_YEAR}
ORDER BY year DESC NULLS LAST, total_profit DESC NULLS LAST, customer NULLS FIRST LIMIT 5""",
    "mart_from_files": _profit_info(_fact()),
    "mart_from_lines": _profit_info(_fact()),
}
