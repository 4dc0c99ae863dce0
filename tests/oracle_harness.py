"""Run registered queries in Spark and their SQL oracle in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

    python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _kind(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return type(v).__name__


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    kinds = {}
    for r in rows:
        for i in order:
            k = _kind(_norm(r[i]))
            if k is not None:
                kinds.setdefault(columns[i], k)
    return cols, len(rows), h, kinds, lines


def compare(spark, name: str, sf_dir: str, con=None, queries=None, oracle=None):
    from flowline.plans.catalog import ORACLE, QUERIES
    queries = queries or QUERIES
    oracle = oracle or ORACLE
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    s = digest(list(sdf.columns), srows)
    t1 = time.time()
    if name not in oracle:
        return {"name": name, "ok": None, "rows": s[1], "spark_sec": round(t1 - t0, 2)}
    cur = con.execute(oracle[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    o = digest(dcols, drows)
    res = {"name": name, "rows": s[1], "oracle_rows": o[1], "cols_ok": s[0] == o[0],
           "hash_ok": s[2] == o[2], "kinds_ok": s[3] == o[3], "spark_sec": round(t1 - t0, 2)}
    res["ok"] = res["cols_ok"] and res["hash_ok"] and res["kinds_ok"] and s[1] == o[1]
    if not res["ok"]:
        res["spark_cols"], res["oracle_cols"] = s[0], o[0]
        res["spark_kinds"], res["oracle_kinds"] = s[3], o[3]
        a, b = set(s[4]), set(o[4])
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
    return res


def main(argv):
    from flowline.plans.catalog import QUERIES
    from flowline.session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:400]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
