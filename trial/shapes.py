"""The driver's tables as the mart's typed tables, and those as the three source files.

Every shape covers its whole tables. Profit has no counterpart there; the line's price
times the difference of its tax and discount rates stands in for it, worked out as an
exact decimal with four places so that rounding to cents has real work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import CUSTOMERS, ORDERS, PRODUCTS
from ledgerloom.tables import Table


# The schemas of the driver's tables, so that no file is opened to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# typed tables


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.lit(None).cast("string").alias("state"),
        F.col("p_retailprice").alias("price_per_product"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    missing = F.lit(None).cast("string")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            missing.alias("email"),
            missing.alias("phone"),
            missing.alias("address"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country"),
            missing.alias("city"),
            missing.alias("state"),
            F.pmod("c_custkey", F.lit(100_000)).cast("int").alias("postal_code"),
            F.col("r_name").alias("region"),
        )
    )


def orders(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Order lines. With ``gaps``, part-filled orders have no customer and returned lines
    name a product no catalogue has, about a third of the lines each."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer_id = F.col("o_custkey").cast("string")
    product_id = F.col("l_partkey").cast("string")
    if gaps:
        customer_id = F.when(F.col("o_orderstatus") != "P", customer_id)
        product_id = F.when(
            F.col("l_returnflag") == "R", F.concat(F.lit("RET-"), product_id)
        ).otherwise(product_id)
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    margin = F.col("l_tax").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_linenumber").alias("row_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        customer_id.alias("customer_id"),
        product_id.alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        (price * margin).cast("double").alias("profit"),
    )


def products_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product listed for two states."""
    return products(spark, sf_dir).withColumn("state", F.explode(F.array(F.lit("NY"), F.lit("CA"))))


def products_with_hot_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products, and the promotional ones once more under one shared id."""
    listed = products(spark, sf_dir)
    shared = listed.where("category = 'PROMO'").withColumn("product_id", F.lit("0"))
    return listed.unionByName(shared)


# source shapes


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("price_per_product").cast("decimal(10,2)").cast("string")
    return _as_source(products(spark, sf_dir), PRODUCTS, price_per_product=price)


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    postal_code = F.lpad(F.col("postal_code").cast("string"), 5, "0")
    return _as_source(customers(spark, sf_dir), CUSTOMERS, postal_code=postal_code)


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_source(
        orders(spark, sf_dir),
        ORDERS,
        order_date=F.date_format("order_date", "d/M/yyyy"),
        ship_date=F.date_format("ship_date", "d/M/yyyy"),
    )


# the same with malformed values among the others


def products_source_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("`Product ID`").cast("long") % 7 == 0, "on request")
    good = products_source(spark, sf_dir)
    return good.withColumn("Price Per Product", F.coalesce(price, "`Price Per Product`"))


def customers_source_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("`Customer ID`").cast("long") % 5 == 0, "K1A 0B1")
    good = customers_source(spark, sf_dir)
    return good.withColumn("Postal Code", F.coalesce(code, "`Postal Code`"))


def orders_source_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("`Order ID`").cast("long")
    good = orders_source(spark, sf_dir)
    return good.withColumns(
        {
            "Order Date": F.when(order % 11 == 0, "31/2/2016").otherwise(F.col("`Order Date`")),
            "Ship Date": F.when(order % 13 == 0, "soon").otherwise(F.col("`Ship Date`")),
        }
    )


def _as_source(df: DataFrame, table: Table, **texts: Column) -> DataFrame:
    return df.select([texts.get(c.name, F.col(c.name)).alias(c.source) for c in table.columns])
