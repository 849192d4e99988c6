"""Run catalogue queries in Spark and their SQL in DuckDB; compare exactly.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [names[i] for i in order]


def spark_type_name(dt) -> str:
    from pyspark.sql import types as T

    simple = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
              T.StringType: "VARCHAR", T.DateType: "DATE", T.BooleanType: "BOOLEAN", T.ShortType: "SMALLINT",
              T.ByteType: "TINYINT", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE"}
    for k, v in simple.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return spark_type_name(dt.elementType) + "[]"
    return dt.simpleString().upper()


def compare_types(spark_schema, duck_desc) -> str:
    st = {f.name: spark_type_name(f.dataType) for f in spark_schema.fields}
    dt = {d[0]: str(d[1]).upper() for d in duck_desc}
    bad = [f"{k}: spark {st[k]} duck {dt.get(k)}" for k in st if dt.get(k) != st[k]]
    return "; ".join(bad)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    snames = sdf.columns
    s_vals, s_cols = _rows(snames, [tuple(r) for r in srows])
    cur = con.execute(sql)
    dnames = [d[0] for d in cur.description]
    type_issues = compare_types(sdf.schema, cur.description)
    d_vals, d_cols = _rows(dnames, cur.fetchall())
    ok_cols = s_cols == d_cols
    ok_n = len(s_vals) == len(d_vals)
    cs, cd = Counter(s_vals), Counter(d_vals)
    ok_v = cs == cd
    detail = ""
    if not ok_cols:
        detail = f"cols spark={s_cols} duck={d_cols}"
    elif not ok_v:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        detail = f"spark-only={only_s} duck-only={only_d}"
    if type_issues:
        detail = (detail + " TYPES " + type_issues).strip()
    return ok_cols and ok_n and ok_v and not type_issues, len(s_vals), len(d_vals), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    from tessera.plans.registry import ORACLE, QUERIES, load_all
    from tessera.session import get_session

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    load_all()
    spark = get_session()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        if name not in ORACLE:
            t0 = time.time()
            n = QUERIES[name](spark, sf_dir).count()
            print(f"ROWS {name}: {n} rows {time.time() - t0:.2f}s")
            continue
        try:
            ok, ns, nd, dt, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, ns, nd, dt, detail = False, -1, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: spark={ns} duck={nd} {dt:.2f}s {detail}")
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv)
