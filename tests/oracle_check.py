"""Run registered queries against their DuckDB oracles (like the driver's gate).

usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query: rows, exact value match, tolerant value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def close(a, b, tol=1e-6):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=tol)
    return a == b


def compare(spark_df, con, sql):
    t = time.time()
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    ts = time.time() - t
    t = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    td = time.time() - t
    res = {"spark_rows": len(srows), "oracle_rows": len(drows), "spark_s": round(ts, 2),
           "oracle_s": round(td, 2), "cols_match": sorted(scols) == sorted(dcols)}
    a, b = norm_rows(scols, srows), norm_rows(dcols, drows)
    res["exact"] = a == b
    res["tolerant"] = len(a) == len(b) and all(len(x) == len(y) and all(close(p, q) for p, q in zip(x, y))
                                               for x, y in zip(a, b))
    if not res["tolerant"]:
        for x, y in zip(a, b):
            if not all(close(p, q) for p, q in zip(x, y)):
                res["first_diff"] = (x, y)
                break
        if not res["cols_match"]:
            res["cols"] = (scols, dcols)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from graphmill.session import local_session
    spark = local_session(8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in oracle:
            t = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} rows={n} (no oracle) {time.time() - t:.1f}s", flush=True)
            continue
        try:
            r = compare(qs[name](spark, sf_dir), con, oracle[name])
        except Exception as ex:  # noqa: BLE001
            r = {"error": repr(ex)[:500]}
        ok = r.get("tolerant") and r.get("cols_match")
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {r}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
