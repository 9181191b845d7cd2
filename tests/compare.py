"""Run named queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .appName("compare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def connection(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int,)):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    number = float(value)
    return "nan" if math.isnan(number) else float(f"{number:.6g}") + 0.0


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, folder):
    start = time.time()
    df = fn(spark, folder)
    got = df.collect()
    spent = time.time() - start
    if sql is None:
        return "rows", f"{len(got)} rows, no SQL", spent
    start = time.time()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    sql_spent = time.time() - start
    if sorted(names) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} against {sorted(names)}", spent
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return "ok", f"{len(a)} rows (sql {sql_spent:.1f}s)", spent
    extra = [r for r in a if r not in set(b)][:3]
    missing = [r for r in b if r not in set(a)][:3]
    return "FAIL", f"{len(a)} against {len(b)} rows; only here {extra}; only there {missing}", spent


def main(argv):
    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    import __spark_entry__ as e

    queries, oracle = e.queries(), e.oracle_sql()
    spark, folder = session(), f"/root/testdata/sf{sf}"
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    bad = 0
    for name in argv or queries:
        for wanted in [q for q in queries if q == name or (name.endswith("*") and q.startswith(name[:-1]))]:
            try:
                status, text, spent = compare(spark, con, wanted, queries[wanted], oracle.get(wanted), folder)
            except Exception as error:  # report and go on
                status, text, spent = "ERROR", str(error)[:1500], 0.0
            bad += status in ("FAIL", "ERROR")
            print(f"{status:5} {wanted:32} {spent:6.1f}s {text}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
