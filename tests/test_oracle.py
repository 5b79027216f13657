"""Every registered query against its SQL on the same tables."""

import glob
import os

import duckdb
import pytest

from tarmac.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, relation.types))
    assert {c: KINDS[str(kinds[c])] for c in columns} == dict(df.dtypes)
    want = relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert len(got) == len(want)
    assert in_order(got) == in_order(want)
    assert got


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
