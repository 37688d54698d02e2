"""The order fact: order lines with the customer and product they refer to."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import spread_key
from ledgerloom.tables import ORDER_FACT

#: Rows of one dimension key, equal ones counted, that are joined in one piece.
PIECE_ROWS = 10_000

_FACT = ORDER_FACT.names
#: What null keys are spread by: columns that tell lines apart and that rollups read anyway.
#: With all columns, a rollup would have to read all of them.
SPREAD_BY = ["order_id", "order_date", "profit", "_customer_key", "_product_key"]
ORDER_COLUMNS, CUSTOMER_COLUMNS, PRODUCT_COLUMNS = _FACT[:7], _FACT[8:11], _FACT[11:]


def order_fact(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    customer_slices: DataFrame | None = None,
    product_slices: DataFrame | None = None,
    piece_rows: int = PIECE_ROWS,
    shuffled: Collection[str] = (),
) -> DataFrame:
    """Left-join customers and products to the order lines and round the profit.

    The keys in the result come from the dimensions, so a line without a match has a
    null key there. A dimension key held by several rows repeats the line for each.

    Spark broadcasts a dimension whose size, planned or seen at run time, is below its
    threshold, and otherwise shuffles. The planned size is that of compressed files; of a
    dimension whose key is in ``shuffled`` (see ``too_large_to_broadcast``) it is known to be
    wrong, and only that one's join has a hint. In the shuffled form null
    keys are spread here, an often ordered key is split by adaptive execution, and a
    dimension key with very many rows is split here when ``dimension_slices`` of the
    dimension is given, best as a stored table, whose size Spark knows.
    """
    lines = orders.select(
        *ORDER_COLUMNS,
        F.round("profit", 2).alias("profit"),
        F.col("customer_id").alias("_customer_key"),
        F.col("product_id").alias("_product_key"),
    )
    with_customer = _look_up(
        lines, "_customer_key", customers.select(CUSTOMER_COLUMNS), customer_slices, piece_rows, shuffled
    )
    with_product = _look_up(
        with_customer, "_product_key", products.select(PRODUCT_COLUMNS), product_slices, piece_rows, shuffled
    )
    return with_product.select(_FACT)


def too_large_to_broadcast(customers: DataFrame, products: DataFrame) -> list[str]:
    """Keys of the dimensions whose rows take more memory than Spark is set to broadcast.

    Of stored tables Spark plans with the bytes of the files, which compression and columns that
    are mostly null make many times smaller than the rows. Here the rows are summed up, by
    a partial aggregate over the columns that are joined.
    """
    spark = customers.sparkSession
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if setting.startswith("-"):  # nothing is broadcast
        return []
    most = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))
    found = []
    for dimension, columns in ((customers, CUSTOMER_COLUMNS), (products, PRODUCT_COLUMNS)):
        texts = [c for c in columns if isinstance(dimension.schema[c].dataType, T.StringType)]
        # Eight bytes a column and eight more, and texts beside them.
        row = F.lit(8 + 8 * len(columns)) + sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in texts)
        total = dimension.where(F.col(columns[0]).isNotNull()).agg(F.sum(row.cast("long"))).first()[0]
        if (total or 0) > most:
            found.append(columns[0])
    return found


def dimension_slices(dimension: DataFrame, key: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keys with more than ``piece_rows`` rows, and over how many slices to deal these.

    The bound is a number of rows and doesn't grow with the table. The rows are counted
    by a partial aggregate; there is at most one key for each ``piece_rows`` rows.
    """
    return (
        dimension.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("hot_key"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > piece_rows)
        .select("hot_key", F.ceil(F.col("rows") / piece_rows).cast("int").alias("slices"))
    )


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one dimension row, with the number of rows."""
    return (
        dimension.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def _look_up(
    lines: DataFrame,
    line_key: str,
    dimension: DataFrame,
    slices: DataFrame | None,
    piece_rows: int,
    shuffled: Collection[str],
) -> DataFrame:
    key = dimension.columns[0]

    def joinable(rows: DataFrame) -> DataFrame:
        return rows.hint("merge") if key in shuffled else rows

    spread = spread_key(F.col(line_key), *SPREAD_BY)
    matches = (spread == F.col(key)) & F.col(line_key).isNotNull()
    if slices is None:
        return lines.join(joinable(dimension), matches, "left")

    # A hot key's rows are dealt over slices and its lines go to each slice. Equal rows
    # become one with a count first, and a count is cut into pieces of piece_rows, so that
    # no slice holds many more rows than that, whether they differ or not. Lines are
    # repeated after the join, by at most piece_rows for each row they meet.
    attributes = dimension.columns[1:]
    of_hot_key = F.col(key) == F.col("hot_key")
    cold = dimension.join(slices, of_hot_key, "left_anti").select(
        "*", F.lit(1).alias("_copies"), F.lit(0).alias("_dimension_slice")
    )
    pieces = (
        dimension.join(slices, of_hot_key)
        .groupBy(*dimension.columns, "slices")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("*", F.explode(F.expr(f"sequence(0, (_rows - 1) div {piece_rows})")).alias("_piece"))
    )
    hot = pieces.select(
        *dimension.columns,
        F.least(F.lit(piece_rows), F.col("_rows") - F.col("_piece") * piece_rows)
        .cast("int")
        .alias("_copies"),
        F.pmod(F.xxhash64(*attributes, "_piece"), F.col("slices")).cast("int").alias("_dimension_slice"),
    )
    # A key may be listed as hot without being in the dimension; its lines stay single.
    present = slices.join(pieces.select(F.col(key).alias("hot_key")).distinct(), "hot_key", "left_semi")
    slice_count = F.coalesce(F.col("slices"), F.lit(1))
    sliced_lines = lines.join(present, spread == F.col("hot_key"), "left").select(
        *lines.columns,
        slice_count.alias("_slice_count"),
        F.explode(F.sequence(F.lit(0), slice_count - 1)).alias("_line_slice"),
    )
    joined = sliced_lines.join(
        joinable(cold.unionByName(hot)),
        matches & (F.col("_line_slice") == F.col("_dimension_slice")),
        "left",
    )
    # A key with several slices has a match in some of them; the others add nothing.
    found = joined.where((F.col("_slice_count") == 1) | F.col(key).isNotNull())
    copies = F.sequence(F.lit(1), F.coalesce(F.col("_copies"), F.lit(1)))
    return found.withColumn("_copy", F.explode(copies)).select(*lines.columns, *dimension.columns)
