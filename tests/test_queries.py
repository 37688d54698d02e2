"""Every registered query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from trial.oracles import ORACLES
from trial.suite import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_of_the_mart_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = Counter(tuple(row) for row in df.select([f"`{c}`" for c in columns]).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {quoted} FROM ({oracle_sql()[name]}) q").fetchall()
    assert found == Counter(expected)
    assert sorted(df.columns) == sorted(
        c[0] for c in duck.execute(oracle_sql()[name]).description
    )


def test_entry(spark):
    assert entry(spark).count() > 0
