"""Every registered query against its SQL twin in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import QUERIES
from conftest import DATA

# DuckDB's names of the types the checks may return.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted(values):
    return sorted(values, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(name, spark, database):
    df = queries()[name](spark, DATA)
    names = sorted(df.columns)
    ours = _sorted([tuple(r[c] for c in names) for r in df.collect()])

    relation = database.execute(oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in relation.description}
    order = [[d[0] for d in relation.description].index(c) for c in names]
    theirs = _sorted([tuple(r[i] for i in order) for r in relation.fetchall()])

    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert ours == theirs
    assert ours


def test_entry_runs(spark):
    assert entry(spark).count() > 0
