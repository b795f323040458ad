"""Run registered queries in Spark and their SQL in DuckDB on the same files and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    """Empty string when equal, else what differs."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    mine = [tuple(plain(v) for v in r) for r in df.select(*cols).collect()]
    if sql is None:
        return "" if mine else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} / {sorted(names)}"
    order = [names.index(c) for c in cols]
    theirs = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    a, b = Counter(mine), Counter(theirs)
    if a == b:
        kinds_a = [type(v) for v in next(iter(a), ())]
        kinds_b = [type(v) for v in next(iter(b), ())]
        if kinds_a != kinds_b and type(None) not in kinds_a + kinds_b:
            return f"types {kinds_a} / {kinds_b}"
        return "" if mine else "no rows"
    return (
        f"rows {len(mine)} / {len(theirs)}; columns {cols}; only here {list((a - b).items())[:3]}; "
        f"only SQL {list((b - a).items())[:3]}"
    )


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = f"/root/testdata/{argv[0]}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if len(argv) > 1 and not any(name.startswith(p) for p in argv[1:]):
            continue
        t = time.time()
        try:
            msg = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as ex:  # noqa: BLE001
            msg = f"{type(ex).__name__}: {str(ex)[:1500]}"
        bad += bool(msg)
        print(f"{'BAD ' if msg else 'ok  '} {name} {time.time() - t:.1f}s {'' if name in oracle else '(no SQL)'} {msg}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
