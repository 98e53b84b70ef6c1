"""Run every query in Spark and DuckDB and compare the rows.

    python -m workbench.check [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workbench.oracle import ORACLE
from workbench.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(r) for r in df.select(*columns).toLocalIterator())


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    relation = con.sql(sql)
    columns = sorted(relation.columns)
    picked = relation.project(", ".join(f'"{c}"' for c in columns))
    return columns, Counter(picked.fetchall())


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, failures = session(), connect(sf_dir), 0
    for name in names or QUERIES:
        df = QUERIES[name](spark, sf_dir)
        columns, got = rows_of_spark(df)
        wanted_columns, wanted = rows_of_sql(con, ORACLE[name])
        types = dict(df.dtypes)
        sql_types = dict(zip(con.sql(ORACLE[name]).columns, con.sql(ORACLE[name]).types))
        same = columns == wanted_columns and got == wanted
        failures += not same
        print(f"{'ok  ' if same else 'DIFF'} {name}: {got.total()} / {wanted.total()} rows")
        for c in columns:
            a, b = types[c], str(sql_types.get(c)).lower()
            if {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar"}.get(a) != b:
                print(f"     type of {c}: {a} / {b}")
        if not same:
            print("    columns", columns, wanted_columns)
            print("    only Spark", list((got - wanted).items())[:5])
            print("    only SQL  ", list((wanted - got).items())[:5])
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
