"""Run registered queries beside their SQL twins in DuckDB.

    python tests/oracle.py [sf] [name ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(plain(x) for x in v) + "]"
        return repr(v)

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(frame, con, sql):
    """None when equal, else what differs."""
    got_rows = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got, want = canonical(frame.columns, got_rows), canonical(names, want_rows)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None


if __name__ == "__main__":
    from tickwarden.plans.catalog import ORACLES, QUERIES
    from tickwarden.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    for setting in os.environ.get("TW_CONF", "").split():
        spark.conf.set(*setting.split("="))
    con = connect(f"/root/testdata/sf{sf}")
    for name in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            frame = QUERIES[name](spark, f"/root/testdata/sf{sf}")
            if name in ORACLES:
                verdict = compare(frame, con, ORACLES[name]) or f"ok {frame.count()} rows"
            else:
                verdict = f"rows only: {frame.count()}"
        except Exception as error:  # report and go on
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name:32s} {time.time() - began:6.2f}s  {verdict}", flush=True)
