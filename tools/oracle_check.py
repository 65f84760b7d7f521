"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tools.oracle_check [sf_dir] [name ...]

Comparison: row count, column names, column types (mapped between engines),
and the multiset of rows (floats rounded to 6 digits, arrays as tuples).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from textlab.sources.tables import TABLES

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "timestamp": "TIMESTAMP", "date": "DATE",
}


def spark_type_name(dt) -> str:
    s = dt.simpleString()
    if s.startswith("array<") and s.endswith(">"):
        inner = s[6:-1]
        return _SPARK_TO_DUCK.get(inner, inner.upper()) + "[]"
    return _SPARK_TO_DUCK.get(s, s.upper())


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if os.environ.get("ORACLE_STRICT"):
            return (1, repr(v + 0.0))
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return (4, str(v))
    return (5, str(v))


def compare(spark, con, name, query, sf_dir):
    t0 = time.time()
    sdf = query.build(spark, sf_dir)
    s_cols = [f.name for f in sdf.schema.fields]
    s_types = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(query.sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        for c in s_cols:
            if s_types[c] != d_types[c]:
                problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        a = sorted(tuple(_norm(r[i]) for i in si) for r in s_rows)
        b = sorted(tuple(_norm(r[i]) for i in di) for r in d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from textlab.plans.registry import all_queries
    from textlab.session import local_session
    spark = local_session()
    con = duck_connect(sf_dir)
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        if q.sql is None:
            n = q.build(spark, sf_dir).count()
            print(f"{name:32s} rows-only {n}")
            continue
        try:
            problems, n, ts, td = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            problems, n, ts, td = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:32s} rows={n:6d} spark={ts:6.2f}s duck={td:6.2f}s {'; '.join(problems)}")
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
