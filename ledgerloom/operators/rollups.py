"""Profit rollups over the order fact.

A rollup is a small declaration that can be run as DataFrame calls or as SQL text.
Each needs only the fact columns it mentions.

``profit_cells`` sums the fact once, at the finest keys that any rollup has, and keeps the sums
unrounded in parts that add up exactly. Every rollup also runs over these cells, and gives the
same cents as over the fact.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.exact import merged_parts, rounded_total, stored_parts, sum_parts

OnError = Literal["raise", "none"]

YEAR = ("year(cast(order_date as date))", "year")
CATEGORY = ("category", "product_category")
SUB_CATEGORY = ("sub_category", "product_sub_category")
CUSTOMER = ("customer_name", "customer")
# Doubles add up differently in another order; these parts don't.
PROFIT_PARTS = sum_parts("profit")
TOTAL_PROFIT = (rounded_total(PROFIT_PARTS), "total_profit")
ORDER_COUNT = ("count(order_id)", "order_count")
# The same measures over cells, by name, and those of a group that is a single cell.
OVER_CELLS = {
    "total_profit": rounded_total(merged_parts("profit")),
    "order_count": "sum(order_count)",
}
OF_CELL = {"total_profit": rounded_total(stored_parts("profit")), "order_count": "order_count"}


@dataclass(frozen=True)
class Rollup:
    """Grouping keys and measures as (expression, name) pairs, a filter and an order.

    ``order`` ends with enough keys to leave no ties.
    """

    keys: tuple[tuple[str, str], ...]
    order: tuple[str, ...]
    measures: tuple[tuple[str, str], ...] = (TOTAL_PROFIT,)
    where: str | None = None
    cells_where: str | None = None  # the same in the names of the keys


PROFIT_INFO = Rollup(
    keys=(YEAR, CATEGORY, SUB_CATEGORY, CUSTOMER),
    measures=(TOTAL_PROFIT, ORDER_COUNT),
    order=("year DESC", "product_category", "product_sub_category", "customer"),
)
BY_YEAR = Rollup(keys=(YEAR,), order=("year DESC",))
BY_YEAR_AND_CATEGORY = Rollup(
    keys=(YEAR, CATEGORY),
    where="category IS NOT NULL",
    cells_where="product_category IS NOT NULL",
    order=("year DESC", "product_category"),
)
BY_CUSTOMER = Rollup(keys=(CUSTOMER,), order=("total_profit DESC", "customer"))
BY_CUSTOMER_AND_YEAR = Rollup(
    keys=(YEAR, CUSTOMER), order=("year DESC", "total_profit DESC", "customer")
)


def profit_cells(fact: DataFrame) -> DataFrame:
    """Lines and exact unrounded profit of the fact by the keys of ``profit_info``.

    Null keys are groups, as in the rollups. To be stored: a frame that isn't reads the fact
    again for each rollup.
    """
    parts = [F.expr(e).alias(f"profit_{name}") for name, e in PROFIT_PARTS.items()]
    keys = [F.expr(e).alias(name) for e, name in PROFIT_INFO.keys]
    return fact.groupBy(keys).agg(F.expr(ORDER_COUNT[0]).alias(ORDER_COUNT[1]), *parts)


def are_cells(df: DataFrame) -> bool:
    return "profit_low" in df.columns


def rollup(
    fact: DataFrame, spec: Rollup, on_error: OnError = "raise", single: bool = False
) -> DataFrame | None:
    """Run a rollup over the fact, or over cells of it.

    ``on_error="none"`` gives None when a column is missing. With ``single`` every group is known
    to be one cell, as over the cells of one fact by all of their keys; nothing is shuffled
    to group them again.
    """
    try:
        cells = are_cells(fact)
        where = spec.cells_where if cells else spec.where
        rows = fact.where(where) if where else fact
        if cells and single:
            if spec.keys != PROFIT_INFO.keys:
                raise ValueError("cells are single by all of their keys only")
            totals = rows.select(
                *[name for _, name in spec.keys], *[F.expr(OF_CELL[name]).alias(name) for _, name in spec.measures]
            )
        else:
            grouped = rows.groupBy([F.expr(name if cells else e).alias(name) for e, name in spec.keys])
            measures = [(OVER_CELLS[name] if cells else e, name) for e, name in spec.measures]
            totals = grouped.agg(*[F.expr(e).alias(name) for e, name in measures])
        ordered = totals.orderBy([_sort_key(term) for term in spec.order])
        _ = ordered.schema
        return ordered
    except AnalysisException:
        if on_error == "none":
            return None
        raise


def _sort_key(term: str):
    name, _, direction = term.partition(" ")
    return F.desc(name) if direction == "DESC" else F.asc(name)


def sql_text(spec: Rollup, cells: bool = False) -> str:
    """The rollup as a query over ``{fact}``, a fact or cells of one."""
    keys = [(name, name) for _, name in spec.keys] if cells else spec.keys
    measures = [(OVER_CELLS[name] if cells else e, name) for e, name in spec.measures]
    columns = ", ".join(f"{e} AS {name}" for e, name in [*keys, *measures])
    condition = spec.cells_where if cells else spec.where
    where = f" WHERE {condition}" if condition else ""
    return f"SELECT {columns} FROM {{fact}}{where} GROUP BY ALL ORDER BY {', '.join(spec.order)}"


def rollup_sql(fact: DataFrame, spec: Rollup, on_error: OnError = "raise") -> DataFrame | None:
    """The same rollup through Spark SQL; the fact is bound to the query, not to a shared name."""
    try:
        return fact.sparkSession.sql(sql_text(spec, are_cells(fact)), fact=fact)
    except AnalysisException:
        if on_error == "none":
            return None
        raise


def profit_info(
    fact: DataFrame, on_error: OnError = "raise", single: bool = False
) -> DataFrame | None:
    """Profit and order lines by year, category, sub-category and customer.

    ``single`` says that ``fact`` is ``profit_cells`` of one fact, not of several put together.
    """
    return rollup(fact, PROFIT_INFO, on_error, single)


def profit_by_year(fact: DataFrame, on_error: OnError = "raise") -> DataFrame | None:
    return rollup(fact, BY_YEAR, on_error)


def profit_by_year_and_category(fact: DataFrame, on_error: OnError = "raise") -> DataFrame | None:
    """Lines without a category are left out."""
    return rollup(fact, BY_YEAR_AND_CATEGORY, on_error)


def profit_by_customer(fact: DataFrame, on_error: OnError = "raise") -> DataFrame | None:
    """By customer name: namesakes are one group, and so are lines without a customer."""
    return rollup(fact, BY_CUSTOMER, on_error)


def profit_by_customer_and_year(fact: DataFrame, on_error: OnError = "raise") -> DataFrame | None:
    return rollup(fact, BY_CUSTOMER_AND_YEAR, on_error)


def profit_info_with_product(info: DataFrame) -> DataFrame:
    """The rows of ``profit_info`` that name a category or at least a sub-category."""
    return info.where("coalesce(product_category, product_sub_category) IS NOT NULL")
