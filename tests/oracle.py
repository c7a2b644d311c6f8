"""Run queries and their SQL side by side: ``python tests/oracle.py SF_DIR [name ...]``."""

import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def answer(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """None when the results agree, else a text that says how they differ."""
    df = query(spark, sf_dir)
    names, got = as_bag(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = as_bag(*answer(con, sql))
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} rows instead of {sum(want.values())}; only here {extra}; only in SQL {lost}"
    return None


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, sqls = entry.queries(), entry.oracle_sql()
    con, failed = connection(sf_dir), []
    for name in names or queries:
        start = time.time()
        try:
            problem = compare(spark, con, queries[name], sqls[name], sf_dir) if name in sqls else (
                None if queries[name](spark, sf_dir).count() >= 0 else "")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
