"""Run registered queries against their DuckDB oracle (the driver's gate,
re-done locally): same columns, same row count, same multiset of rows."""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from stepfold.plans.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 8)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
        return problems
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    stypes = dict(sdf.dtypes)
    dtypes = {c: str(t) for c, t in zip(dcols, [d[1] for d in rel.description])}
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    a = sorted(srows, key=_key)
    b = sorted(drows, key=_key)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} differing rows, first: spark={diff[0][0]} duck={diff[0][1]}")
    return problems


def main(argv):
    import time

    from stepfold.plans import registry
    from stepfold.session import build_session

    sf = os.environ.get("CHECK_SF", "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    names = argv[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, ors = registry.queries(), registry.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        if name not in ors:
            n = qs[name](spark, sf_dir).count()
            print(f"NOSQL {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            probs = compare(spark, con, name, qs[name], ors[name], sf_dir)
        except Exception as e:  # report and go on
            probs = [f"error {type(e).__name__}: {str(e)[:600]}"]
        status = "OK  " if not probs else "FAIL"
        bad += bool(probs)
        print(f"{status} {name} ({time.time() - t0:.1f}s) {'; '.join(probs)}", flush=True)
    print(f"{bad} failing of {len(names or qs)}")


if __name__ == "__main__":
    main(sys.argv)
