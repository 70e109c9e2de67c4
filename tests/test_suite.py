"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry
from vouch.suite.queries import QUERIES

SF = f"{DATA}/sf0.001"
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((repr(tuple(r)) for r in df.select(*columns).collect()))
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(repr(r) for r in duck.execute(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall())
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 30


def test_profile_sample(spark):
    rows = QUERIES["profile_sample"](spark, SF).collect()
    assert len(rows) == 29
    assert all(r.sample_values.startswith("[") and r.sample_values != "[]" for r in rows)
