"""Run queries against DuckDB on the same files and compare.

``python tests/oracle.py [--sf 0.01] [--plain] [name ...]`` prints one line per failing or slow query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", float(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda r: [(x is None, str(type(x)), x if not isinstance(x, (list, dict)) else str(x)) for x in r],
    )


def family(v):
    return type(v).__name__


def compare(spark, con, run, sql, sf_dir):
    """(ok, message, seconds)."""
    start = time.time()
    df = run(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    if not sql:
        return bool(got), f"rows only: {len(got)}", took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    have = rows_of(df.columns, [tuple(r) for r in got])
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}", took
    if len(have) != len(want):
        return False, f"{len(have)} rows, expected {len(want)}", took
    bad = [(a, b) for a, b in zip(have, want) if a != b or [family(x) for x in a] != [family(x) for x in b]]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[0][0]} expected {bad[0][1]}", took
    if not want:
        return True, "EMPTY RESULT", took
    return True, f"{len(want)} rows", took


def main(argv):
    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    plain = argv[:1] == ["--plain"]  # a session without the library's settings
    argv = argv[1:] if plain else argv
    from __spark_entry__ import oracle_sql, queries
    from riskframe.session import get_session

    sf_dir = f"/root/testdata/sf{sf}"
    if plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, sqls = queries(), oracle_sql()
    names = [n for n in qs if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    failed = []
    for name in names:
        try:
            ok, msg, took = compare(spark, con, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, msg, took = False, f"{type(e).__name__}: {str(e)[:700]}", 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if not ok:
            failed.append(name)
        if not ok or argv or took > 3 or msg.startswith(("EMPTY", "rows only")):
            print(f"{'ok  ' if ok else 'FAIL'} {name} {took:.2f}s {msg}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
