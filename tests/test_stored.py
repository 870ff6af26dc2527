"""Every report over the hospital tables as files, read with their declared types."""

import re
from collections import Counter

import pytest

from checks import CHECKS
from checks.case import Context
from wardbook.sources.schemas import TABLES, schema
from wardbook.sources.tables import open_tables

SF = "/root/testdata/sf0.001"
REPORTS = [n for n in CHECKS if re.match(r"r\d+_(?!\d)", n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """All hospital tables as parquet files, with column names in upper case as a database gives them."""
    folder = tmp_path_factory.mktemp("hospital")
    t = Context(spark, SF).t
    for name in TABLES:
        t[name].toDF(*[c.upper() for c in t[name].columns]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_table_loads_as_declared(spark, stored):
    tables = open_tables(spark, stored)
    assert set(tables) == set(TABLES) and len(TABLES) == 52
    for name in tables:
        assert tables[name].schema == schema(name)
    # Nothing is lost to a cast: keys that are set in the samples are whole numbers in the loaded tables.
    given = Context(spark, SF).t
    for name in ("slnserpro", "slnprohoj", "slnserhoj", "innmsumpa"):
        key = schema(name).names[0]
        assert tables[name].filter(f"{key} is null").count() == 0 < given[name].count() == tables[name].count()


@pytest.mark.parametrize("name", REPORTS)
def test_report_over_stored_tables(spark, stored, name):
    context = Context(spark, SF)
    context.__dict__["t"] = open_tables(spark, stored)
    got, want = CHECKS[name].build(context), CHECKS[name].query(spark, SF)
    assert got.columns == want.columns
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(map(tuple, want.collect()))
