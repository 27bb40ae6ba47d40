"""Compares every query with its SQL: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

MISSING = "\0null"


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    columns = []
    for c in df.columns:
        columns.append([
            MISSING if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v))
            else format(v, ".12g") if isinstance(v, float) else str(v)
            for v in df[c].tolist()
        ])
    return sorted(zip(*columns))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark_df, con, sql: str) -> str:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    from collections import Counter
    x, y = Counter(a), Counter(b)
    return f"{len(a)} rows, expected {len(b)}; only ours {list((x - y))[:2]}; only theirs {list((y - x))[:2]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="termfold-compare-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracle = E.oracle_sql()
    for name, query in E.queries().items():
        if name not in oracle or names and name not in names:
            continue
        t = time.time()
        try:
            df = query(spark, sf_dir)
            message = differences(df, con, oracle[name])
            message = message or f"ok {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:600]}"
        bad += not message.startswith("ok")
        print(f"{name:26s} {time.time() - t:6.1f}s {message}", flush=True)
    print("differences:", bad)
    sys.exit(bool(bad))
