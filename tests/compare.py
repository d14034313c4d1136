"""Run registered queries against their SQL: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, fn, sql, sf: str) -> str | None:
    """None if both sides agree in columns and rows, else what differs."""
    df = fn(spark, sf)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf), 0
    sqls = oracle_sql()
    for name, fn in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = difference(spark, con, fn, sqls[name], sf)
            else:
                problem = None if fn(spark, sf).collect() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
