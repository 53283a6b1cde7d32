"""Runs a registered query next to its SQL twin and compares the rows."""
from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_value(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    start = time.time()
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if got_columns != want_columns:
        problems.append(f"columns {got_columns} != {want_columns}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not problems and got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(diff)} rows differ, first:\n   spark {str(diff[0][0])[:600]}\n   sql   {str(diff[0][1])[:600]}")
    types = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    loose = [f"{n}: {t} / {types.get(n)}" for n, t in df.dtypes if not _same(t, types.get(n, ""))]
    return problems, len(got), took, loose


def _same(spark_type: str, sql_type: str) -> bool:
    pairs = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
    return pairs.get(spark_type) == sql_type


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = f"/root/testdata/sf{argv[0]}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = connection(sf_dir)
    bad = []
    for name in argv[1:] or queries:
        try:
            if name not in oracles:
                start = time.time()
                n = len(queries[name](spark, sf_dir).collect())
                print(f"rows only {name}: {n} rows {time.time() - start:.1f}s", flush=True)
                continue
            problems, n, took, loose = compare(spark, con, queries[name], oracles[name], sf_dir)
        except Exception as error:
            problems, n, took, loose = [f"{type(error).__name__}: {str(error)[:1500]}"], 0, 0.0, []
        print(("FAIL" if problems else "ok  "), name, n, f"{took:.1f}s", loose or "", flush=True)
        for p in problems:
            print("   ", p, flush=True)
        if problems:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
