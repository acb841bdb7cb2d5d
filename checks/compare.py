"""Runs queries and their SQL side by side: python -m checks.compare [directory] [name ...]"""

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from .oracles import oracle_sql
from .registry import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def rows_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def types_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), oracle_sql()
    failed = 0
    for name in names:
        began = time.time()
        df = queries()[name](spark, sf_dir)
        got = rows_of(df)
        spent = time.time() - began
        if name not in sql:
            print(f"{name:40s} rows only {len(got[1]):7d} {spent:6.2f}s", flush=True)
            continue
        want = rows_of_sql(connection, sql[name])
        same = got == want
        failed += not same
        print(f"{name:40s} {'ok' if same else 'DIFFERS':9s} {len(got[1]):7d} {spent:6.2f}s", flush=True)
        sql_types, spark_types = types_of_sql(connection, sql[name]), dict(df.dtypes)
        pairs = {c: (spark_types[c], sql_types.get(c)) for c in spark_types}
        expected = {
            "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP",
        }
        odd = {c: p for c, p in pairs.items() if expected.get(p[0].split(" ")[0]) != p[1]}
        if odd:
            print("   types:", odd)
        if not same:
            print("   columns:", got[0], want[0] if want[0] != got[0] else "")
            bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
            print("   rows:", len(got[1]), len(want[1]), "different:", len(bad), *bad[:3], sep="\n     ")
    print("failed:", failed)


if __name__ == "__main__":
    main()
