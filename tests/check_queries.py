"""Run registered queries beside their SQL: python tests/check_queries.py <sf dir> [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from shiplog.workloads import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def comparable(columns, rows):
    """Sorted columns and rows; as text, so that 1, 1.0 and True differ."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(spark, con, name, sf_dir):
    """(spark result, sql result), each as sorted column names and sorted rows."""
    df = QUERIES[name](spark, sf_dir)
    got = comparable(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    want = comparable([d[0] for d in result.description], result.fetchall())
    return got, want


def main():
    sf_dir, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            got, want = compare(spark, con, name, sf_dir)
        except Exception as e:
            bad += 1
            print(f"\nERROR {name}: {str(e)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if got == want:
            print(f"\nok    {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
            continue
        bad += 1
        print(f"\nDIFF  {name}: {len(got[1])} rows, sql {len(want[1])}, {took:.1f}s")
        if got[0] != want[0]:
            print("  columns", got[0], want[0])
        a, b = set(got[1]), set(want[1])
        print("  only spark", sorted(a - b)[:3], "\n  only sql  ", sorted(b - a)[:3], flush=True)
    print(f"\n{bad} bad")


if __name__ == "__main__":
    main()
