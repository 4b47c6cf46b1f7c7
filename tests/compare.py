"""Compares every registered query with its SQL over the same tables.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def rows(columns: list[str], tuples) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in tuples)


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return sorted(columns), rows(columns, result.fetchall())


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    return sorted(frame.columns), rows(frame.columns, frame.collect())


def main() -> int:
    import __spark_entry__ as driver
    from clickweave.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    oracle, failed = driver.oracle_sql(), 0
    for name, query in driver.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            columns, found = spark_rows(query(spark, sf_dir))
        except Exception as error:  # report and go on with the next query
            print(f"FAIL {name}: {str(error)[:600]}")
            failed += 1
            continue
        took = time.time() - start
        if name not in oracle:
            print(f"rows {name}: {len(found)} in {took:.1f}s")
            continue
        try:
            expected_columns, expected = sql_rows(sf_dir, oracle[name])
        except Exception as error:
            print(f"FAIL {name}: SQL {str(error)[:600]}")
            failed += 1
            continue
        same = columns == expected_columns and found == expected
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name}: {len(found)} rows in {took:.1f}s")
        if not same:
            print("  ", columns, expected_columns, len(expected))
            print("   only here:", [row for row in found if row not in set(expected)][:3])
            print("   only SQL: ", [row for row in expected if row not in set(found)][:3])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
