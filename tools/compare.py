"""Run the registered queries on Spark and their SQL on DuckDB, and compare names, types, rows and values.

    python tools/compare.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from checks import CHECKS  # noqa: E402
from checks.samples import GIVEN  # noqa: E402

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def spark_side(df) -> tuple[dict, Counter]:
    names = sorted(df.columns)
    types = dict(df.dtypes)
    types = {n: TYPES.get(types[n], types[n].upper()) for n in names}
    return types, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_side(con, sql: str) -> tuple[dict, Counter]:
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    names = sorted(types)
    quoted = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"select {quoted} from ({sql})").fetchall()
    return {n: types[n] for n in names}, Counter(rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con, bad = session(), database(args.sf), 0
    for name, check in CHECKS.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        try:
            began = time.time()
            types, rows = spark_side(check.query(spark, args.sf))
            took = time.time() - began
            if check.sql is None:
                print(f"rows  {name}: {sum(rows.values())} rows, {took:.1f} s")
                continue
            began = time.time()
            sql_types, sql_rows = duck_side(con, check.sql)
            sql_took = time.time() - began
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}")
            continue
        said = f"{sum(rows.values())} rows, {took:.1f} s, sql {sql_took:.1f} s"
        if types != sql_types:
            diff = {n: (types.get(n), sql_types.get(n)) for n in {*types, *sql_types} if types.get(n) != sql_types.get(n)}
            bad += 1
            print(f"TYPES {name}: {said}: {diff}")
        if rows != sql_rows:
            bad += 1
            extra, missing = list((rows - sql_rows).items())[:3], list((sql_rows - rows).items())[:3]
            print(f"DIFF  {name}: {said} against {sum(sql_rows.values())}\n  only here {extra}\n  only sql  {missing}")
        elif types == sql_types:
            print(f"ok    {name}: {said}" + ("   EMPTY" if not rows else ""))
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
