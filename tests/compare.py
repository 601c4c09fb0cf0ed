"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

As a script: `python tests/compare.py SF_DIR [name ...]`.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark, con, name: str, sf_dir: str):
    """None when both agree, else a short description; with both times."""
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return (None if got else "no rows"), t1 - t0, None, len(got)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    t2 = time.time()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}", t1 - t0, t2 - t1, len(got)
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", t1 - t0, t2 - t1, len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(df.columns)}\n  spark {a}\n  duck  {b}", t1 - t0, t2 - t1, len(got)
    return None, t1 - t0, t2 - t1, len(got)


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").appName("tests")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    from __spark_entry__ import queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in wanted or queries():
        try:
            problem, s, d, n = differences(spark, con, name, sf_dir)
        except Exception as e:  # a failing query is one finding among others
            problem, s, d, n = f"{type(e).__name__}: {str(e)[:1500]}", 0, None, 0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:38s} rows={n:<7d} spark={s:6.2f}s duck={d if d is None else round(d, 2)}",
              "" if problem is None else problem, flush=True)
    print("bad:", bad)
