"""Run every registered query next to its DuckDB oracle and compare the results.

Compare = same row count, same column names, same multiset of rows (values normalised to
text, floats by repr). Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, con, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(rows), sec=round(t1 - t0, 2), note="rows-only")
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    h1, l1 = digest(cols, rows)
    h2, l2 = digest(ocols, orows)
    ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
    out = dict(name=name, ok=ok, rows=len(rows), oracle_rows=len(orows), sec=round(t1 - t0, 2))
    if not ok:
        out["cols"] = (cols, ocols)
        diff1 = sorted(set(l1) - set(l2))[:3]
        diff2 = sorted(set(l2) - set(l1))[:3]
        out["spark_only"], out["oracle_only"] = diff1, diff2
    return out


def main(argv):
    from salesflow.session import local_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad, summary = 0, {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), con, sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        summary[name] = {True: "match", False: "MISMATCH", None: "rows-only"}[r.get("ok")]
        print(r, flush=True)
    print(json.dumps({"sf_dir": sf_dir, "failed": bad, "queries": summary}))
    print(f"FAILED: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
