from __future__ import annotations

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom import (
    CUSTOMERS,
    ORDER_FACT,
    ORDERS,
    PRODUCTS,
    Mart,
    dimension_slices,
    order_fact,
    repeated_keys,
)
from ledgerloom.functions import spread_key
from ledgerloom.operators.fact import too_large_to_broadcast
from ledgerloom.plans import mart
from tests.conftest import CUSTOMER_ROWS, ORDER_ROWS, PRODUCT_ROWS, bag, rows

D = datetime.date


def line(spark, *changes):
    base = dict(zip(ORDERS.schema.names, ORDER_ROWS[0]))
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], ORDERS.schema)


def test_fact_of_the_shared_tables(fact):
    lamp, rope, kiln = ("P-lamp", "Lighting", "Lanterns"), ("P-rope", "Rigging", "Cordage"), ("P-kiln", "Pottery", "Kilns")
    weir, fen, nobody = ("K20", "Ottoline Marsh", "Eire"), ("K31", "Ottoline Marsh", "Eire"), (None, None, None)
    rope_line = ("A-71", D(2019, 2, 27), D(2019, 3, 4), "Courier", 1, 9.5, 0.0, -2.15, *weir, *rope)
    assert fact.schema == ORDER_FACT
    assert Counter(rows(fact)) == Counter(
        [
            ("A-71", D(2019, 2, 27), D(2019, 3, 2), "Drone", 4, 18.25, 0.05, 6.4, *weir, *lamp),
            rope_line,
            rope_line,
            ("B-08", D(2020, 11, 30), D(2020, 12, 1), "Courier", 2, 36.5, 0.15, 6.4, *fen, *lamp),
            ("C-55", D(2020, 1, 9), D(2020, 1, 20), "Barge", 1, 820.0, 0.3, 91.75, *nobody, *kiln),
        ]
    )


def test_fact_equals_sql_with_using(spark, fact, orders, customers, products):
    same = spark.sql(
        """SELECT order_id, order_date, ship_date, ship_mode, quantity, o.price, discount, profit,
                   c.c_id AS customer_id, customer_name, country, p.p_id AS product_id, category, sub_category
            FROM {o} o LEFT JOIN (SELECT *, customer_id AS c_id FROM {c}) c USING (customer_id)
            LEFT JOIN (SELECT *, product_id AS p_id FROM {p}) p USING (product_id)""",
        o=orders, c=customers, p=products.withColumnRenamed("price_per_product", "listed_price"),
    )
    assert bag(same) == bag(fact)


@pytest.mark.parametrize("customer_id", ["K99", None])
def test_line_without_a_customer_is_kept_without_its_key(spark, customers, products, customer_id):
    fact = order_fact(line(spark, {"customer_id": customer_id}), customers, products)
    row = fact.first()
    assert (row["order_id"], row["customer_id"], row["customer_name"]) == ("A-71", None, None)
    assert row["product_id"] == "P-lamp"


@pytest.mark.parametrize("product_id", ["P-none", None])
def test_line_without_a_product_is_kept_without_its_key(spark, customers, products, product_id):
    row = order_fact(line(spark, {"product_id": product_id}), customers, products).first()
    assert (row["product_id"], row["category"], row["customer_id"]) == (None, None, "K20")


def test_null_keys_do_not_match_null_or_filler_keys(spark, customers):
    lines = line(spark, {"product_id": None})
    row = ["order_id", "order_date", F.round("profit", 2), "customer_id", "product_id"]
    filler = lines.select(spread_key(F.col("product_id"), *row)).first()[0]
    assert filler.startswith("null-")
    listed = [(filler, "X", "Y", "Z", None, 1.0), (None, "X", "Y", "Z", None, 1.0)]
    products = spark.createDataFrame(listed, PRODUCTS.schema)
    assert [r["category"] for r in order_fact(lines, customers, products).collect()] == [None]


def test_repeated_product_repeats_the_line(spark, orders, customers):
    products = spark.createDataFrame(
        [*PRODUCT_ROWS, ("P-lamp", "Lighting", "Lanterns", "Storm lantern", "WA", 23.5)],
        PRODUCTS.schema,
    )
    found = Counter(r["order_id"] for r in order_fact(orders, customers, products).collect())
    assert found == {"A-71": 4, "B-08": 2, "C-55": 1}
    assert bag(repeated_keys(products, "product_id")) == [("P-lamp", 2), ("P-rope", 2)]


@pytest.mark.parametrize(
    ("profit", "rounded"),
    [(2.675, 2.68), (1.005, 1.01), (-0.005, -0.01), (0.004, 0.0), (None, None)],
)
def test_profit_is_rounded_half_up_per_line(spark, customers, products, profit, rounded):
    assert order_fact(line(spark, {"profit": profit}), customers, products).first()["profit"] == rounded


def skewed(spark, lines=3000):
    """A third of the lines without a customer, a third with one customer; one product id
    with many catalogue rows, some of them equal."""
    orders = spark.range(lines).select(
        F.col("id").cast("int").alias("row_id"),
        F.concat(F.lit("O"), (F.col("id") / 3).cast("int")).alias("order_id"),
        F.lit(D(2016, 1, 1)).alias("order_date"),
        F.lit(D(2016, 1, 2)).alias("ship_date"),
        F.lit("S").alias("ship_mode"),
        F.expr("CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'C1' ELSE concat('C', id % 50) END").alias("customer_id"),
        F.expr("CASE WHEN id % 100 = 0 THEN 'HOT' WHEN id % 7 = 0 THEN NULL ELSE concat('P', id % 20) END").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(1.0).alias("price"),
        F.lit(0.0).alias("discount"),
        F.lit(0.5).alias("profit"),
    )
    customers = spark.range(40).select(
        *[F.concat(F.lit(c), F.col("id")).alias(n) for n, c in (("customer_id", "C"), ("customer_name", "N"), ("country", "L"))]
    )
    hot = spark.range(2500).selectExpr("'HOT' AS product_id", "concat('K', id % 3) AS category", "concat('S', id % 2) AS sub_category")
    others = spark.range(15).selectExpr("concat('P', id) AS product_id", "'K' AS category", "'S' AS sub_category")
    return orders, customers, hot.union(others).union(others.where("product_id = 'P3'"))


def count_by_row(df):
    return Counter(rows(df))


def by_hand(orders, customers, products):
    names = {c[0]: c[1:] for c in rows(customers)}
    listed = {}
    for key, *attributes in rows(products):
        listed.setdefault(key, []).append((key, *attributes))
    result = Counter()
    for o in orders.collect():
        customer = (o.customer_id, *names[o.customer_id]) if o.customer_id in names else (None,) * 3
        for product in listed.get(o.product_id, [(None,) * 3]):
            result[(*o[1:5], *o[7:11], *customer, *product)] += 1
    return result


def hot(spark, *keys):
    return spark.createDataFrame(list(keys), "hot_key string, slices int")


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
@pytest.mark.parametrize("piece_rows", [10_000, 100, 1])
@pytest.mark.parametrize("keys", [[], [("HOT", 3)], [("HOT", 2500), ("P3", 2), ("P19", 4), ("unused", 5)]])
def test_skewed_tables_against_brute_force(spark, broadcast, keys, piece_rows):
    """P19 is ordered but not in the catalogue, so calling it hot must not lose its lines."""
    orders, customers, products = skewed(spark)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        slices = hot(spark, *keys)
        fact = order_fact(orders, customers, products, product_slices=slices, piece_rows=piece_rows)
        result = count_by_row(fact)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    expected = by_hand(orders.select(ORDERS.schema.names), customers, products)
    assert result == Counter({(k[0], k[1], k[2], k[3], *k[4:]): n for k, n in expected.items()})


def test_hot_keys_are_found_with_their_slices(spark):
    _, customers, products = skewed(spark)
    assert rows(dimension_slices(products, "product_id", 1000)) == [("HOT", 3)]
    assert rows(dimension_slices(products, "product_id", 2500)) == []
    assert bag(dimension_slices(products, "product_id", 1)) == [("HOT", 2500), ("P3", 2)]
    assert rows(dimension_slices(products, "product_id")) == []
    assert rows(dimension_slices(customers, "customer_id")) == []


def test_thousands_of_moderately_hot_keys_are_all_found(spark):
    many = spark.range(60_000).selectExpr("concat('M', id % 3000) AS product_id", "'K' AS category")
    found = rows(dimension_slices(many, "product_id", piece_rows=10))
    assert len(found) == 3000 and {r[1] for r in found} == {2}


def test_one_hot_key_of_few_attributes_goes_to_many_tasks(spark, shuffled_joins, tmp_path):
    lines = skewed(spark, 34)[0].withColumn("product_id", F.lit("HOT"))
    hot_rows = "'HOT' AS product_id", "concat('K', id % 3) AS category", "'S' AS sub_category"
    spark.range(400_000).selectExpr(*hot_rows).write.parquet(str(tmp_path / "p"))
    products = spark.read.parquet(str(tmp_path / "p"))
    dimension_slices(products, "product_id").write.parquet(str(tmp_path / "s"))
    slices = spark.read.parquet(str(tmp_path / "s"))
    assert rows(slices) == [("HOT", 40)]
    fact = order_fact(lines, skewed(spark)[1], products, product_slices=slices)
    sizes = [r[1] for r in fact.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 34 * 400_000
    assert len(sizes) >= 12 and max(sizes) < sum(sizes) / 4


@pytest.fixture
def shuffled_joins(spark):
    """Small thresholds, so that small tables are joined and split as large ones are."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_null_keys_are_spread_over_the_tasks(spark, shuffled_joins, tmp_path):
    orders, customers, products = skewed(spark, 6000)
    nothing = F.lit(None).cast("string")
    days = F.date_add(F.lit(D(2016, 1, 1)), F.col("row_id") % 2000)
    no_customer = orders.withColumns(
        {"customer_id": nothing, "order_id": nothing, "profit": F.lit(None).cast("double"), "order_date": days}
    )
    no_customer.write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = order_fact(stored, customers, products.limit(0))
        sizes = [r[1] for r in fact.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 6000
    assert len(sizes) == 16 and max(sizes) < 6000 / 16 * 3


def test_an_often_ordered_key_is_split_at_run_time(spark, shuffled_joins, tmp_path):
    orders, customers, products = skewed(spark, 60_000)
    orders.repartition(8).write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    fact = order_fact(stored, customers, products.limit(0))
    assert fact.count() == 60_000
    fact.collect()
    assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()


def test_no_more_columns_are_read_than_needed(spark, tmp_path, orders, customers, products):
    for name, df in (("o", orders), ("c", customers), ("p", products)):
        df.write.parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / n)) for n in "ocp"]
    plan = order_fact(*read).select("country", "profit")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,country:string>" in plan
    assert "ReadSchema: struct<product_id:string>" in plan
    assert "ship_mode" not in plan and "email" not in plan


def test_dimension_rows_without_a_key_are_not_shuffled(spark, shuffled_joins, tmp_path, orders, customers, products):
    customers.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    plan = order_fact(orders, stored, products)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(customer_id)" in plan


def test_customer_rows_are_the_declared_ones(customers):
    assert customers.schema == CUSTOMERS.schema and bag(customers) == sorted(CUSTOMER_ROWS, key=repr)


@pytest.mark.parametrize("hot_rows", [0, 10_001])
def test_a_dimension_of_small_files_and_many_rows_is_not_broadcast(
    spark, tmp_path, monkeypatch, orders, products, hot_rows
):
    """Its planned size, of compressed files, is below the threshold; its rows aren't."""
    made = []
    monkeypatch.setattr(mart, "order_fact", lambda *a, **k: made.append(order_fact(*a, **k)) or made[-1])
    fields = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CUSTOMERS.schema[3:]]
    named = "'the same name' AS customer_name", "CAST(NULL AS string) AS email", *fields
    ids = spark.range(20_000).selectExpr("concat('K', id) AS customer_id", *named)
    many = ids.unionByName(spark.range(hot_rows).selectExpr("'HOT' AS customer_id", *named))
    many.write.parquet(str(tmp_path / "c"))
    products.write.parquet(str(tmp_path / "p"))
    stored, few = (spark.read.parquet(str(tmp_path / n)) for n in "cp")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500KB")
    try:
        planned = stored.select("customer_id", "customer_name", "country")._jdf.queryExecution().optimizedPlan().stats()
        assert int(str(planned.sizeInBytes())) < 500 * 1024
        assert too_large_to_broadcast(stored, few) == ["customer_id"]
        found = Mart(spark, str(tmp_path))
        found.create_order_fact(stored, orders, few)
        plan = made[0]._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert too_large_to_broadcast(stored, few) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    joins = [line for line in plan.splitlines() if "Join" in line and "LeftOuter" in line]
    assert sum("SortMergeJoin" in line and "customer_id" in line for line in joins) == 1
    assert sum("BroadcastHashJoin" in line and "product_id" in line for line in joins) == 1
    assert bag(found.read_order_fact()) == bag(order_fact(orders, many, products))
