"""Run registered queries beside their SQL twins in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    if type(value).__name__ == "Decimal":
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, function, sql, sf_dir):
    df = function(spark, sf_dir)
    got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = table_rows([d[0] for d in cursor.description], cursor.fetchall())
    return got, want


def main(sf_dir, names):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = e.queries(), e.oracle_sql()
    failed = []
    for name in names or queries:
        start = time.time()
        try:
            if name not in oracles:
                n = queries[name](spark, sf_dir).count()
                print(f"-- {name}: {n} rows, no SQL, {time.time() - start:.1f}s", flush=True)
                continue
            got, want = compare(spark, con, queries[name], oracles[name], sf_dir)
        except Exception as error:
            failed.append(name)
            print(f"!! {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
            continue
        same = got == want
        print(f"{'ok' if same else 'XX'} {name}: {len(got[1])} rows, {time.time() - start:.1f}s", flush=True)
        if not same:
            failed.append(name)
            print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            a, b = set(map(repr, got[1])), set(map(repr, want[1]))
            print("   only spark", list(a - b)[:3])
            print("   only sql  ", list(b - a)[:3])
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
