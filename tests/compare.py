"""Run registered queries beside their SQL and compare all rows."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(root: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, (bool, str)):
        return v
    if isinstance(v, int):
        return float(v)
    raise TypeError(f"{type(v)} in a result: {v!r}")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, root: str, name: str, build, sql: str | None, con=None):
    df = build(spark, root)
    got = df.collect()
    if sql is None:
        return len(got), None
    con = con or connect(root)
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    have = rows_of(df.columns, got)
    if have[0] != want[0]:
        return len(got), f"columns {have[0]} != {want[0]}"
    if len(have[1]) != len(want[1]):
        return len(got), f"rows {len(have[1])} != {len(want[1])}"
    for a, b in zip(have[1], want[1]):
        if a != b:
            return len(got), f"{have[0]}\n  spark {a}\n  sql   {b}"
    return len(got), None


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from ledgerline.session import local_session

    root = argv[0]
    names = argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(root), e.oracle_sql(), []
    for name, build in e.queries().items():
        if names and not any(name == n for n in names):
            continue
        t = time.time()
        try:
            n, err = compare(spark, root, name, build, sqls.get(name), con)
        except Exception as x:
            n, err = -1, "".join(traceback.format_exception_only(x))[:1500]
        print(f"{'ok ' if err is None else 'BAD'} {name} rows={n} {time.time()-t:.1f}s", flush=True)
        if err:
            bad.append(name)
            print("   ", err, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
