"""Exact sums in parts, and rollups over cells of the fact."""

from __future__ import annotations

import datetime
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import Mart, profit_cells, profit_info, rollup, rollup_sql
from ledgerloom.functions.exact import merged_parts, rounded_total, sum_parts
from ledgerloom.tables import PROFIT_CELLS_SCHEMA
from tests.conftest import bag, rows
from tests.test_rollups import EXPECTED, FACT, FUNCTIONS

D = datetime.date
NAN, INF = float("nan"), float("inf")


def draw(rnd, kind):
    return {
        "cents": lambda: round(rnd.uniform(-1e4, 1e4), 2),
        "large cents": lambda: round(rnd.uniform(-9e12, 9e12), 2),
        "binary": lambda: rnd.uniform(-10, 10),
        "millionths": lambda: round(rnd.uniform(-1e8, 1e8), 5),
        "half cents": lambda: rnd.choice([0.004, 0.005, -0.005, 2.675, 1.005, -1.115]),
        "tiny": lambda: rnd.choice([1e-12, 4e-13, -1e-300, 5e-7, 0.0, -0.0]),
        "nulls": lambda: rnd.choice([None, 1.25]),
        "at the bounds": lambda: rnd.choice([1e13, -1e13, 9999999999999.99, 1e9, 999999999.999999, 123456789.1234567]),
    }[kind]()


KINDS = ["cents", "large cents", "binary", "millionths", "half cents", "tiny", "nulls", "at the bounds"]


def exactly(values):
    """The total by decimals, as the double nearest to its cents."""
    given = [Decimal(repr(v)).quantize(Decimal("1e-12"), ROUND_HALF_UP) for v in values if v is not None]
    return float(sum(given).quantize(Decimal("0.01"), ROUND_HALF_UP)) if given else None


def test_totals_equal_decimals_under_any_partitioning(spark):
    rnd = random.Random(8)
    groups = {(kind, i): [draw(rnd, kind) for _ in range(rnd.randint(1, 40))] for kind in KINDS for i in range(12)}
    groups["mixed", 0] = [draw(rnd, kind) for kind in KINDS for _ in range(20)]
    records = [(f"{kind} {i}", v) for (kind, i), values in groups.items() for v in values]
    expected = {f"{kind} {i}": exactly(values) for (kind, i), values in groups.items()}
    df = spark.createDataFrame(records, "g string, profit double")
    parts = sum_parts("profit")
    once = df.groupBy("g").agg(F.expr(rounded_total(parts)).alias("total"))
    assert dict(rows(once)) == expected
    for n in (1, 3, 7):
        cells = df.repartition(n).groupBy("g", F.pmod(F.hash("profit"), F.lit(n)).alias("cell")).agg(
            *[F.expr(e).alias(f"p_{name}") for name, e in parts.items()]
        )
        twice = cells.groupBy("g").agg(F.expr(rounded_total(merged_parts("p"))).alias("total"))
        assert dict(rows(twice)) == expected


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([1.5, NAN], NAN),
        ([1.5, INF], INF),
        ([INF, -INF], NAN),
        ([1e30, 1.0], 1e30),
        ([9e25] * 3, 2.7e26),  # each is a decimal, the total is too large for one
        ([None, None], None),
        ([9e12] * 50, 4.5e14),
        ([-0.01] * 3, -0.03),
    ],
)
def test_what_decimals_cannot_hold_adds_up_as_doubles(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "profit double")
    found = df.agg(F.expr(rounded_total(sum_parts("profit"))).alias("t")).first().t
    assert found == total or (found != found and total != total)


def test_no_row_of_whole_cents_becomes_a_decimal(spark):
    df = spark.range(10).selectExpr("id % 2 as g", "id / 100D as profit").where("profit >= 0")
    watched = df.selectExpr("g", "profit").agg(F.expr(sum_parts("profit")["hard"]).alias("hard"))
    assert watched.first().hard == 0


@pytest.mark.parametrize("function", FUNCTIONS, ids=lambda f: f.__name__)
def test_rollups_over_cells_equal_those_over_the_fact(fact, function):
    cells = profit_cells(fact)
    assert rows(function(cells)) == EXPECTED[function]
    assert function(cells).dtypes == function(fact).dtypes
    assert rows(rollup_sql(cells, FUNCTIONS[function])) == EXPECTED[function]


def test_null_groups_and_unrounded_profit_come_out_the_same(spark):
    rnd = random.Random(4)
    days = [None, D(2019, 1, 1), D(2019, 7, 1), D(2020, 5, 5)]
    records = [
        (
            rnd.choice([None, "X"]), rnd.choice(days), rnd.choice([None, "A", "B"]), rnd.choice([None, "s"]),
            rnd.choice([None, "Z", "Y"]), rnd.choice([None, 0.004, 0.005, rnd.uniform(-5, 5), 12.34]),
        )
        for _ in range(400)
    ]
    fact = spark.createDataFrame(records, FACT)
    cells = profit_cells(fact)
    for spec in FUNCTIONS.values():
        assert rows(rollup(cells, spec)) == rows(rollup(fact, spec))
    lines = defaultdict(int)
    for order, day, *keys, _ in records:
        lines[day and day.year, *keys] += order is not None
    assert {tuple(r[:4]): r.order_count for r in profit_info(cells).collect()} == dict(lines)


def test_stored_cells_answer_all_rollups_without_the_fact(spark, data_dir, fact):
    """The fact is read once, for the cells; the plans of the rollups read only these."""
    mart = Mart(spark, data_dir)
    assert mart.create_profit_cells(fact)
    cells = mart.read_profit_cells()
    assert cells.schema.names == PROFIT_CELLS_SCHEMA.names
    mart.create_profit_info(cells)
    assert bag(mart.read_profit_info()) == sorted(EXPECTED[profit_info], key=repr)
    for function in FUNCTIONS:
        result = function(cells)
        assert rows(result) == EXPECTED[function]
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") + plan.count("Scan parquet") >= 1
        assert "profit_cells.parquet" in "".join(result.inputFiles()) and "order_fact" not in plan


def test_cells_of_nothing(spark):
    cells = profit_cells(spark.createDataFrame([], FACT))
    assert cells.count() == 0
    for spec in FUNCTIONS.values():
        assert rows(rollup(cells, spec)) == []
