"""Run each query in Spark and its SQL in DuckDB and compare names, types and values."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations"]
KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
    "DATE": "date", "BOOLEAN": "boolean",
}


def connect(folder):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def normal(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else 0.0 if v == 0.0 and isinstance(v, float) else v
                 for v in row)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def compare(spark, con, fn, sql, folder):
    """Returns (message, rows); an empty message means equal."""
    df = fn(spark, folder)
    columns = sorted(df.columns)
    got = sorted((normal(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=key)
    if sql is None:
        return "", len(got)
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"columns {columns} != {sorted(rel.columns)}", len(got)
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    types = [(c, t, kinds[c]) for c, t in sorted(df.dtypes) if KINDS.get(kinds[c]) != t]
    if types:
        return f"types {types}", len(got)
    order = [rel.columns.index(c) for c in columns]
    want = sorted((normal(tuple(r[i] for i in order)) for r in rel.fetchall()), key=key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else ""), len(got)


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = f"/root/testdata/sf{os.environ.get('SF', '0.01')}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    failed = []
    for name in names:
        start = time.time()
        try:
            message, rows = compare(spark, con, queries[name], oracles.get(name), folder)
        except Exception as e:  # report and go on
            message, rows = f"{type(e).__name__}: {str(e)[:700]}", -1
        label = "FAIL" if message else "ok" if name in oracles else "rows"
        print(f"{label:5} {time.time() - start:6.2f}s {rows:7} {name} {message}", flush=True)
        if message:
            failed.append(name)
    print(f"{len(names)} queries, {len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
