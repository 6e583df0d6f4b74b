"""Compare registered queries with their SQL in DuckDB: columns, number of rows, and values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def rows_of(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """Empty text where both sides agree, else what differs."""
    ours = entry.queries()[name](spark, folder)
    got = rows_of(ours.columns, [tuple(row) for row in ours.collect()])
    theirs = connection.sql(entry.oracle_sql()[name])
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} <> {sorted(theirs.columns)}"
    want = rows_of(theirs.columns, theirs.fetchall())
    if got == want:
        return "" if got else "no rows"
    return (
        f"rows {got.total()} <> {want.total()}; only ours {list((got - want).items())[:2]}; "
        f"only theirs {list((want - got).items())[:2]}"
    )


if __name__ == "__main__":
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scale = sys.argv[1]
    folder = f"/root/testdata/sf{scale}"
    connection = connect(folder)
    for name in sys.argv[2:] or list(entry.queries()):
        began = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - began:6.1f}s {problem or 'ok'}", flush=True)
