"""Compares registered queries with their SQL on one set of tables. ``python tests/compare.py 0.01 [names]``"""

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return str(v)
    if v is None:
        return "∅"
    return f"{type(v).__name__}:{v}" if not isinstance(v, (int, str)) else repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, folder):
    """None if equal, else a description of the first difference."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra = sorted(set(got[1]) - set(want[1]))[:2]
    lacking = sorted(set(want[1]) - set(got[1]))[:2]
    return f"{len(got[1])} rows, wanted {len(want[1])}; extra {extra} lacking {lacking}"


if __name__ == "__main__":
    from burstguard.session import build_session
    from __spark_entry__ import oracle_sql, queries

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name in sys.argv[2:] or list(queries()):
        start = time.time()
        sql = oracle_sql().get(name)
        try:
            diff = compare(spark, con, name, queries()[name], sql, folder) if sql else "no sql"
        except Exception as error:
            diff = f"ERROR {str(error)[:500]}"
        failed += diff not in (None, "no sql")
        print(f"{name:28s} {time.time() - start:6.2f}s {diff or 'ok'}"[:900], flush=True)
    print("failed:", failed)
