"""Run registered queries and their SQL side by side: ``python tests/compare.py SF [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def register(con: duckdb.DuckDBPyConnection, sf_dir: str) -> None:
    for table in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) and float(value).is_integer():
        return int(value)
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_value(row[name]) for name in names) for row in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [item[0] for item in result.description]
    names = sorted(columns)
    place = [columns.index(name) for name in names]
    rows = [tuple(_value(row[i]) for i in place) for row in result.fetchall()]
    return names, sorted(rows, key=repr)


def main() -> None:
    import __spark_entry__ as entry
    from tests.session import local_session

    sf_dir, wanted = f"/root/testdata/sf{sys.argv[1]}", sys.argv[2:]
    spark, con = local_session(), duckdb.connect()
    register(con, sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in wanted or queries:
        start = time.time()
        try:
            names, rows = spark_rows(queries[name](spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        spent = time.time() - start
        if name not in sql:
            print(f"rows  {name}: {len(rows)} rows, {spent:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            other_names, other = duck_rows(con, sql[name])
        except Exception as error:  # noqa: BLE001
            print(f"SQL   {name}: {str(error)[:1500]}", flush=True)
            continue
        if names == other_names and rows == other:
            print(f"ok    {name}: {len(rows)} rows, {spent:.1f}s / {time.time() - start:.1f}s", flush=True)
            continue
        print(f"DIFF  {name}: {len(rows)} vs {len(other)} rows", flush=True)
        if names != other_names:
            print("      columns", names, other_names)
            continue
        ours, theirs = set(rows), set(other)
        print("      columns", names)
        print("      only spark", sorted(ours - theirs, key=repr)[:2])
        print("      only duck ", sorted(theirs - ours, key=repr)[:2], flush=True)


if __name__ == "__main__":
    main()
