"""Run registered queries next to their comparison SQL and report differences.

usage: python tools/check.py [--sf 0.01 | --root folder] [--only name,name] [--module domain]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bazaarmill.plans  # noqa: E402,F401
from bazaarmill.registry import QUERIES  # noqa: E402
from bazaarmill.sources.tables import ALL_NAMES  # noqa: E402


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(root: str):
    con = duckdb.connect()
    for t in ALL_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def kind(dtype) -> str:
    d = str(dtype).lower()
    for a, b in (("bigint", "int"), ("integer", "int"), ("int", "int"), ("varchar", "str"), ("string", "str")):
        if d.startswith(a):
            return b
    return d


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v) if v is not None else None


def compare(spark, con, q, root) -> tuple[str, float, int]:
    t0 = time.time()
    df = q(spark, root)
    got = df.collect()
    took = time.time() - t0
    if q.sql is None:
        return "rows-only", took, len(got)
    rel = con.sql(q.sql)
    names, types = rel.columns, [str(x) for x in rel.types]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(names)}", took, len(got)
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = {n: (st[n], t) for n, t in zip(names, types) if (st[n], t) not in OK_TYPES}
    cols = sorted(names)
    key = lambda r: tuple("" if x is None else x for x in r)
    a = sorted((tuple(plain(r[c]) for c in cols) for r in got), key=key)
    ix = [names.index(c) for c in cols]
    b = sorted((tuple(plain(r[i]) for i in ix) for r in want), key=key)
    if len(a) != len(b):
        return f"ROWS spark={len(a)} sql={len(b)}", took, len(a)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"VALUES {len(bad)} of {len(a)} differ, cols={cols}\n   spark={bad[0][0]}\n   sql  ={bad[0][1]}", took, len(a)
    if wide:
        return f"TYPES {wide}", took, len(a)
    return "ok", took, len(a)


OK_TYPES = {
    ("int", "INTEGER"), ("bigint", "BIGINT"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN"),
}


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("--only", default="")
    p.add_argument("--module", default="")
    p.add_argument("--root", default="", help="folder with the tables, instead of --sf")
    a = p.parse_args()
    root = a.root or f"/root/testdata/sf{a.sf}"
    spark, con = session(), duck(root)
    failed = 0
    for name, q in QUERIES.items():
        if a.only and name not in a.only.split(","):
            continue
        if a.module and not q.build.__module__.endswith(a.module):
            continue
        try:
            status, took, n = compare(spark, con, q, root)
        except Exception as e:  # report and go on with the next query
            status, took, n = "ERROR " + str(e)[:600] + (traceback.format_exc()[-300:] if "--v" in sys.argv else ""), 0, 0
        good = status in ("ok", "rows-only")
        failed += not good
        print(f"{'  ' if good else '!!'} {name:34s} {took:6.2f}s {n:8d} {status}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
