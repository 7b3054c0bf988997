"""Every registered query against its SQL oracle: names, types, rows and values."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from bizops.plans import catalog, oracles

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(rows):
    """Sort rows on values rounded so that the last bits of a double cannot reorder them."""
    def key(row):
        return [(v is None, round(v, 4) if isinstance(v, float) else v if v is not None else 0) for v in row]
    return sorted(rows, key=key)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [(c[0], str(c[1])) for c in result.description]
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == dict(columns)
    names = [c for c, _ in columns]
    expected = ordered(result.fetchall())
    got = ordered([tuple(row[c] for c in names) for row in df.collect()])
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert all(same(a, b) for a, b in zip(g, e)), (g, e)


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert "reorder_point" in df.columns and df.count() > 0
