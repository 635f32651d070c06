"""Compare registered queries with their SQL in DuckDB: same columns, types of values, rows."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return (float, "nan")
    return (type(value), value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_cell(row[i]) for i in order) for row in rows], key=repr)


def differences(df, con, sql):
    """Empty when equal, else a short account of the first difference."""
    result = con.execute(sql)
    names, expected = [d[0] for d in result.description], result.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(_rows(df.columns, got), _rows(names, expected), strict=True):
        if a != b:
            return f"{a} != {b}"
    return ""


def main(sf, *wanted):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                found = differences(df, con, sql[name])
            else:
                found = "" if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {time.time() - start:6.2f}s {name} {found}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(bool(main(*sys.argv[1:])))
