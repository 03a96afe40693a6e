"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    """One spelling per value for both engines; types stay apart except number widths."""
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"DECIMAL {v}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return "date " + v.isoformat()
    return str(v)


def kind(t: str) -> str:
    t = t.lower()
    return {"varchar": "string", "bigint": "bigint", "integer": "int", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}.get(t, t)


def compare(spark, con, name, query, sql, folder):
    """None when equal, else what differs."""
    frame = query(spark, folder)
    cols = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in frame.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    types_sql = dict(zip(names, [kind(str(d[1])) for d in cur.description]))
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    types_spark = {f.name: kind(f.dataType.simpleString()) for f in frame.schema.fields}
    if types_spark != types_sql:
        return f"types {[(c, types_spark[c], types_sql[c]) for c in cols if types_spark[c] != types_sql[c]]}"
    at = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in rows]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got.sort()
    want.sort()
    for a, b in zip(got, want):
        if a != b:
            n = sum(x != y for x, y in zip(got, want))
            return f"{n} rows differ, columns {cols}: first {a} != {b}"
    return None if got else "both empty"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from stepwise.session import HOT_ROWS_CONF, local_session

    sf, names, hot = "0.01", [], None
    args = iter(argv)
    for a in args:
        if a == "--sf":
            sf = next(args)
        elif a == "--hot":
            hot = next(args)
        else:
            names.append(a)
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(8, 8), connect(folder)
    if hot:
        spark.conf.set(HOT_ROWS_CONF, hot)
    bad = 0
    for name, q in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, con, name, q, oracle_sql()[name], folder)
            else:
                problem = None if q(spark, folder).count() >= 0 else "?"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) and 1)
