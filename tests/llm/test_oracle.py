"""Queries with SQL against DuckDB on the same tables: columns, types and values."""

from collections import Counter

import duckdb
import pytest

from wardbook.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    told = con.sql(ORACLE_SQL[name])
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    assert dict(found.dtypes) == dict(zip(told.columns, (TYPES[str(t)] for t in told.types), strict=True))
    expected = Counter(told.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert sum(expected.values()) > 100
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == expected
