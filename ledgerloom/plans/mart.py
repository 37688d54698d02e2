"""The mart: a data folder with its source files, tables and rollups."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Literal, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from ledgerloom import paths
from ledgerloom.layers import (
    SWEEP_HOURS,
    Layer,
    Staging,
    current_version,
    fingerprint,
    is_made_from,
    load_table,
    store_table,
    table_path,
)
from ledgerloom.operators import rollups
from ledgerloom.operators.conform import OnBadValue, conform, watch_bad_values
from ledgerloom.operators.fact import dimension_slices, order_fact, too_large_to_broadcast
from ledgerloom.sources import read_csv, read_json, read_workbooks
from ledgerloom.tables import (
    CUSTOMERS,
    ORDER_FACT,
    ORDERS,
    PRODUCTS,
    PROFIT_CELLS_SCHEMA,
    PROFIT_INFO_SCHEMA,
    Table,
)

log = logging.getLogger(__name__)


class Mart:
    """Reads, writes and rollups of one data folder.

    ``policy="strict"`` raises every error. ``policy="lenient"`` follows the older
    contract: writers return False, readers of missing data return an empty typed
    frame, and rollups over a frame without the needed columns return None.

    ``on_bad_value="null"`` types malformed values as null; ``bad_values`` then holds,
    per enriched table and column, how many there were. What the JSON reader itself makes
    null (a value of the wrong type, a document that is cut) never reaches the conversion:
    the strict policy raises there unless malformed values may become null, and
    ``bad_records`` holds the number of such records once the frame read is written raw.

    CSV and JSON files may hold records over several lines; large files are read in ranges
    by many tasks. With ``multi_line`` off, they have one record per line. With ``split`` off,
    Spark's own readers take the others, one task for each file.
    """

    def __init__(
        self,
        spark: SparkSession,
        data_dir: str,
        policy: Literal["strict", "lenient"] = "strict",
        on_bad_value: OnBadValue = "fail",
        staging: Staging = "swap",
        multi_line: bool = True,
        sweep_hours: float = SWEEP_HOURS,
        split: bool = True,
    ) -> None:
        lenient = policy == "lenient"
        self.spark = spark
        self.data_dir = data_dir
        self.on_bad_value = on_bad_value
        self.staging = staging
        self.sweep_hours = sweep_hours
        self.multi_line = multi_line
        self.split = split
        self.bad_values: dict[str, dict[str, int]] = {}
        self.bad_records: dict[str, int] = {}
        self.on_malformed = "null" if lenient or on_bad_value == "null" else "raise"
        self._orders_read: tuple[DataFrame, Observation] | None = None
        self.on_missing = "empty" if lenient else "raise"
        self.on_error = "flag" if lenient else "raise"
        self.on_bad_frame = "none" if lenient else "raise"

    # sources

    def read_products_csv(self, file: str = "Products.csv") -> DataFrame:
        return read_csv(
            self.spark,
            self._file(file),
            PRODUCTS,
            multi_line=self.multi_line,
            on_missing=self.on_missing,
            split=self.split,
        )

    def read_customers_excel(self, file: str = "Customer.xlsx") -> DataFrame:
        return read_workbooks(self.spark, self._file(file), CUSTOMERS, on_missing=self.on_missing)

    def read_orders_json(self, file: str = "Orders.json") -> DataFrame:
        malformed = Observation()
        df = read_json(
            self.spark,
            self._file(file),
            ORDERS,
            multi_line=self.multi_line,
            on_missing=self.on_missing,
            on_malformed=self.on_malformed,
            watch=malformed,
            split=self.split,
        )
        self._orders_read = df, malformed
        return df

    # raw layer

    def write_products_raw(self, df: DataFrame, made_from: str | None = None) -> bool:
        return self._store("raw", PRODUCTS.name, df, made_from)

    def write_customers_raw(self, df: DataFrame, made_from: str | None = None) -> bool:
        return self._store("raw", CUSTOMERS.name, df, made_from)

    def write_orders_raw(self, df: DataFrame, made_from: str | None = None) -> bool:
        stored = self._store("raw", ORDERS.name, df, made_from)
        if stored and self._orders_read and df is self._orders_read[0] and df.inputFiles():
            self.bad_records[ORDERS.name] = self._orders_read[1].get["records"]
            if self.bad_records[ORDERS.name]:
                log.warning("%d malformed records in %s", self.bad_records[ORDERS.name], ORDERS.name)
        return stored

    def read_raw(self, table: Table) -> DataFrame:
        return self._load("raw", table.name, table.source_schema)

    # enriched layer

    def write_products_enriched(self, df: DataFrame, made_from: str | None = None) -> bool:
        return self._enrich(PRODUCTS, df, made_from)

    def write_customers_enriched(self, df: DataFrame, made_from: str | None = None) -> bool:
        return self._enrich(CUSTOMERS, df, made_from)

    def write_orders_enriched(self, df: DataFrame, made_from: str | None = None) -> bool:
        return self._enrich(ORDERS, df, made_from)

    def read_products_enriched(self) -> DataFrame:
        return self._load("enriched", PRODUCTS.name, PRODUCTS.schema)

    def read_customers_enriched(self) -> DataFrame:
        return self._load("enriched", CUSTOMERS.name, CUSTOMERS.schema)

    def read_orders_enriched(self) -> DataFrame:
        return self._load("enriched", ORDERS.name, ORDERS.schema)

    # fact and rollups

    def create_order_fact(
        self,
        customers_df: DataFrame,
        orders_df: DataFrame,
        products_df: DataFrame,
        made_from: str | None = None,
    ) -> bool:
        """Join and store the fact. Dimension keys with very many rows are looked for first.

        They are kept beside the fact while it is made, so that Spark knows how few they
        are and chooses the joins with them by their size. A dimension whose rows are more
        than Spark broadcasts, however small its files, is shuffled.
        """
        path = table_path(self.data_dir, "enriched", "order_fact")
        at = {key: paths.sibling(path, f"slices-{key}") for key in ("customer_id", "product_id")}

        def slices(dimension: DataFrame, key: str) -> DataFrame | None:
            dimension_slices(dimension, key).write.parquet(at[key])
            stored = self.spark.read.parquet(at[key])
            return None if stored.isEmpty() else stored

        def fact() -> DataFrame:
            return order_fact(
                orders_df,
                customers_df,
                products_df,
                slices(customers_df, "customer_id"),
                slices(products_df, "product_id"),
                shuffled=too_large_to_broadcast(customers_df, products_df),
            )

        try:
            return self._store_built("enriched", "order_fact", fact, made_from)
        finally:
            for made in at.values():
                paths.delete(self.spark, made)

    def read_order_fact(self) -> DataFrame:
        return self._load("enriched", "order_fact", ORDER_FACT)

    def create_profit_cells(self, order_fact_df: DataFrame, made_from: str | None = None) -> bool:
        """Store the sums that all rollups can be made from, by one pass over the fact."""
        return self._store_built(
            "aggregated", "profit_cells", lambda: rollups.profit_cells(order_fact_df), made_from
        )

    def read_profit_cells(self) -> DataFrame:
        return self._load("aggregated", "profit_cells", PROFIT_CELLS_SCHEMA)

    def create_profit_info(
        self, order_fact_df: DataFrame, made_from: str | None = None, single: bool = False
    ) -> bool:
        """Store the profit info of a fact, or of its cells (``single`` if they are of one fact)."""
        return self._store_built(
            "aggregated", "profit_info", lambda: rollups.profit_info(order_fact_df, single=single), made_from
        )

    def read_profit_info(self) -> DataFrame:
        return self._load("aggregated", "profit_info", PROFIT_INFO_SCHEMA)

    def profit_by_year(self, order_fact_df: DataFrame) -> DataFrame | None:
        return rollups.profit_by_year(order_fact_df, self.on_bad_frame)

    def profit_by_year_and_category(self, order_fact_df: DataFrame) -> DataFrame | None:
        return rollups.profit_by_year_and_category(order_fact_df, self.on_bad_frame)

    def profit_by_customer(self, order_fact_df: DataFrame) -> DataFrame | None:
        return rollups.profit_by_customer(order_fact_df, self.on_bad_frame)

    def profit_by_customer_and_year(self, order_fact_df: DataFrame) -> DataFrame | None:
        return rollups.profit_by_customer_and_year(order_fact_df, self.on_bad_frame)

    # helpers

    def _file(self, name: str) -> str:
        return f"{self.data_dir.rstrip('/')}/files/{name}"

    def _load(self, layer: Layer, name: str, schema: T.StructType) -> DataFrame:
        return load_table(
            self.spark, table_path(self.data_dir, layer, name), schema, self.on_missing
        )

    def _store(self, layer: Layer, name: str, df: DataFrame, made_from: str | None) -> bool:
        return self._store_built(layer, name, lambda: df, made_from)

    def _enrich(self, table: Table, df: DataFrame, made_from: str | None) -> bool:
        if self.on_bad_value == "fail":
            return self._store_built("enriched", table.name, lambda: conform(df, table), made_from)

        counts = Observation()
        stored = self._store_built(
            "enriched",
            table.name,
            lambda: conform(watch_bad_values(df, table, counts), table, "null"),
            made_from,
        )
        if stored:
            self.bad_values[table.name] = counts.get
            log.warning("malformed values in %s: %s", table.name, counts.get)
        return stored

    def _store_built(
        self, layer: Layer, name: str, build: Callable[[], DataFrame], made_from: str | None
    ) -> bool:
        try:
            df = build()
        except Exception:
            if self.on_error == "flag":
                log.exception("could not build %s", name)
                return False
            raise
        path = table_path(self.data_dir, layer, name)
        return store_table(df, path, self.staging, self.on_error, made_from, self.sweep_hours)


class MartTables(NamedTuple):
    order_fact: DataFrame
    profit_info: DataFrame
    profit_by_year: DataFrame
    profit_by_year_and_category: DataFrame
    profit_by_customer: DataFrame
    profit_by_customer_and_year: DataFrame


#: To be raised when a step comes to make other tables of the same inputs.
STEPS_VERSION = 1


class Journal:
    """Which steps of a flow are done, told by the tables themselves.

    Every stored table carries a fingerprint of what it was made from: the step's settings and
    the versions of the tables, or the names, sizes and times of the files, that it reads. A
    step is done if its table was made from what it would be made from now. As the fingerprint
    is published together with the table, a flow that was lost anywhere goes on behind the
    last step that ended, and a source file that changed makes only what depends on it anew.
    """

    def __init__(self, mart: Mart, resume: bool) -> None:
        self.mart, self.resume = mart, resume
        self.made: list[str] = []

    def files(self, name: str) -> list[tuple[str, int, int]]:
        return paths.listing(self.mart.spark, self.mart._file(name))

    def version(self, layer: Layer, name: str) -> str | None:
        found = current_version(self.mart.spark, table_path(self.mart.data_dir, layer, name))
        return found and found.name

    def step(self, layer: Layer, name: str, inputs: object, make: Callable[[str], bool]) -> None:
        """``make`` stores the table with the fingerprint it is given, unless that is done."""
        stamp = fingerprint(STEPS_VERSION, layer, name, inputs)
        path = table_path(self.mart.data_dir, layer, name)
        if self.resume and is_made_from(self.mart.spark, path, stamp):
            log.info("%s/%s is up to date", layer, name)
            return
        make(stamp)
        self.made.append(f"{layer}/{name}")


def build_mart(
    spark: SparkSession,
    data_dir: str,
    on_bad_value: OnBadValue = "fail",
    staging: Staging = "swap",
    multi_line: bool = True,
    resume: bool = False,
) -> MartTables:
    """Files to raw, raw to enriched, enriched to the fact, the fact to its rollups.

    Source files are parsed once: the enriched tables are built from the stored raw
    tables, which are columnar and split where the files may not be. The three sources
    do not depend on each other and share the cluster. Every error is raised, so nothing
    is built from a table that failed. The fact is summed once, into cells; profit_info and
    the rollups, which are returned lazily, are made from these.

    With ``resume`` only those tables are made whose inputs aren't the ones they were made
    from (see ``Journal``). Values that became null are reported by the steps that run.
    """
    mart = Mart(
        spark, data_dir, on_bad_value=on_bad_value, staging=staging, multi_line=multi_line
    )
    journal = Journal(mart, resume)

    def source(table: Table, file: str, read: Callable[[], DataFrame], raw: Callable, enriched: Callable) -> None:
        inputs = [journal.files(file), multi_line, on_bad_value]
        journal.step("raw", table.name, inputs, lambda stamp: raw(read(), stamp))
        inputs = [journal.version("raw", table.name), on_bad_value]
        journal.step("enriched", table.name, inputs, lambda stamp: enriched(mart.read_raw(table), stamp))

    def products() -> None:
        source(
            PRODUCTS, "Products.csv", mart.read_products_csv, mart.write_products_raw, mart.write_products_enriched
        )

    def customers() -> None:
        source(
            CUSTOMERS,
            "Customer.xlsx",
            mart.read_customers_excel,
            mart.write_customers_raw,
            mart.write_customers_enriched,
        )

    def orders() -> None:
        source(ORDERS, "Orders.json", mart.read_orders_json, mart.write_orders_raw, mart.write_orders_enriched)

    with ThreadPoolExecutor() as pool:
        steps = [inheritable_thread_target(spark)(step) for step in (orders, customers, products)]
        for step in [pool.submit(step) for step in steps]:
            step.result()

    journal.step(
        "enriched",
        "order_fact",
        [journal.version("enriched", table.name) for table in (CUSTOMERS, ORDERS, PRODUCTS)],
        lambda stamp: mart.create_order_fact(
            customers_df=mart.read_customers_enriched(),
            orders_df=mart.read_orders_enriched(),
            products_df=mart.read_products_enriched(),
            made_from=stamp,
        ),
    )
    fact = mart.read_order_fact()
    journal.step(
        "aggregated",
        "profit_cells",
        journal.version("enriched", "order_fact"),
        lambda stamp: mart.create_profit_cells(fact, stamp),
    )
    cells = mart.read_profit_cells()
    journal.step(
        "aggregated",
        "profit_info",
        journal.version("aggregated", "profit_cells"),
        lambda stamp: mart.create_profit_info(cells, stamp, single=True),
    )
    log.info("made %s", journal.made)
    return MartTables(
        order_fact=fact,
        profit_info=mart.read_profit_info(),
        profit_by_year=mart.profit_by_year(cells),
        profit_by_year_and_category=mart.profit_by_year_and_category(cells),
        profit_by_customer=mart.profit_by_customer(cells),
        profit_by_customer_and_year=mart.profit_by_customer_and_year(cells),
    )
