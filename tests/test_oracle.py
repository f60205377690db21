"""Every registered query against its SQL in DuckDB."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from salesmill.plans import checks, oracles

SF_DIR = "/root/testdata/sf0.001"
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    return sorted([repr(v) for v in row] for row in rows)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    duck_types = [str(d[1]).replace(" ", "") for d in result.description]
    spark_types = [DUCK_TYPES.get(t, t.upper()) for _, t in df.select(*columns).dtypes]
    assert spark_types == duck_types
    expected = comparable(result.fetchall())
    assert expected
    assert comparable(df.select(*columns).collect()) == expected


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["product_line", "city"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(checks.QUERIES) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
