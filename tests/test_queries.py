"""Every registered query against its SQL, on the smallest given tables."""

import importlib.util
from pathlib import Path

import pytest

from checks import CHECKS
from tools.compare import database, duck_side, spark_side

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", [n for n, c in CHECKS.items() if c.sql is not None])
def test_query_equals_sql(spark, con, name):
    check = CHECKS[name]
    types, rows = spark_side(check.query(spark, SF))
    sql_types, sql_rows = duck_side(con, check.sql)
    assert types == sql_types
    assert rows == sql_rows


def test_entry_points(spark):
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_points", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).columns[:2] == ["FECHA_CONSULTA", "SEDE"]
    assert set(module.oracle_sql()) <= set(module.queries())
