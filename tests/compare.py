"""Run a query in Spark and its SQL in DuckDB and compare the rows.

As a script: ``python tests/compare.py [-d DATA_DIR] [name …]``.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{path}/{name}.parquet'")
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when schema and rows agree."""
    expected = con.sql(sql)
    names = sorted(spark_df.columns)
    if names != sorted(expected.columns):
        return [f"columns {names} != {sorted(expected.columns)}"]
    found = []
    spark_types = dict(spark_df.dtypes)
    duck_types = dict(zip(expected.columns, map(str, expected.types)))
    for name in names:
        if _DUCK_TYPES.get(spark_types[name], spark_types[name]) != duck_types[name]:
            found.append(f"type of {name}: {spark_types[name]} != {duck_types[name]}")
    got = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=repr)
    want = sorted(expected.select(*[f'"{n}"' for n in names]).fetchall(), key=repr)
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        got_set, want_set = set(got), set(want)
        extra = [r for r in got if r not in want_set][:3]
        missing = [r for r in want if r not in got_set][:3]
        found.append(f"rows differ in {names}: only here {str(extra)[:600]}, only in SQL {str(missing)[:600]}")
    return found


def main() -> None:
    from lumenrec.plans import catalogue
    from lumenrec.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("-d", "--data", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.data)
    for name, run in catalogue.QUERIES.items():
        if args.names and name not in args.names and not any(n.endswith("*") and name.startswith(n[:-1]) for n in args.names):
            continue
        start = time.time()
        try:
            result = run(spark, args.data)
            if name in catalogue.ORACLES:
                found = differences(result, con, catalogue.ORACLES[name])
                status = "ok" if not found else "DIFF " + "; ".join(found)
            else:
                status = f"rows only: {result.count()}"
        except Exception as error:  # report and go on with the next query
            status = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {status}", flush=True)


if __name__ == "__main__":
    main()
