"""Run registered queries and compare each with its SQL: ``python tests/compare.py <folder> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("docgroups")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v
        return v

    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> str:
    """Empty when both results hold the same rows."""
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows; {ours[:2]} {theirs[:2]}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else ""


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark, con, failed = local_session(), database(folder), 0
    sql = oracle_sql()
    for name, query in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sql:
                problem = compare(df, con, sql[name])
            else:
                problem = "" if df.count() > 0 else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql " if name in sql else "rows"
        print(f"{time.time() - start:6.1f}s {kind} {'FAIL' if problem else 'ok  '} {name} {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
