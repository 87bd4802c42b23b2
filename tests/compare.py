"""Run registered queries beside their SQL oracles and compare all rows, in any order."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    return value.normalize() if isinstance(value, Decimal) else value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(table) -> tuple[list[str], Counter]:
    return sorted(table.columns), _bag(table.columns, [tuple(row) for row in table.collect()])


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    relation = connection.sql(sql)
    return sorted(relation.columns), _bag(relation.columns, relation.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry_points

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracles)))
    print("without query:", sorted(set(oracles) - set(queries)))
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            columns, rows = spark_rows(queries[name](spark, sf_dir))
            seconds = time.time() - start
            expected_columns, expected = oracle_rows(connection, oracles[name])
            good = columns == expected_columns and rows == expected
            print(f"{'ok ' if good else 'BAD'} {name} rows={sum(rows.values())} {seconds:.2f}s")
            if not good:
                failed += 1
                print("  columns", set(columns) ^ set(expected_columns))
                print("  spark only ", list((rows - expected).items())[:2])
                print("  oracle only", list((expected - rows).items())[:2])
        except Exception as error:
            failed += 1
            print(f"ERR {name}: {str(error)[:1500]}")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
