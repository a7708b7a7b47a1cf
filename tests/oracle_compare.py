"""Run registered Spark questions against their DuckDB SQL and compare results.

Comparison is order-insensitive after sorting columns by name: row count, column names, a
coarse type class per column, and every value (decimals and dates exactly, doubles bit for
bit).  Usable from pytest and as ``python -m tests.oracle_compare [sf_dir] [names...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, decimal.Decimal):
        return (2, str(v.normalize()) if v != 0 else "0")
    if isinstance(v, float):
        return (3, repr(v))
    if isinstance(v, int):
        return (4, str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return (5, v.isoformat())
    return (6, str(v))


def _type_class(name: str) -> str:
    n = name.lower()
    for key, cls in (("decimal", "decimal"), ("double", "double"), ("float", "double"),
                     ("bigint", "int"), ("int", "int"), ("long", "int"), ("hugeint", "int"),
                     ("bool", "bool"), ("date", "date"), ("timestamp", "ts"),
                     ("string", "str"), ("varchar", "str")):
        if key in n:
            return cls
    return n


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    cols = sorted(s_cols)
    type_diff = {c: (s_types[c], d_types[c]) for c in cols
                 if _type_class(s_types[c]) != _type_class(d_types[c])}
    if type_diff:
        out["type_diff"] = type_diff
    si = [s_cols.index(c) for c in cols]
    di = [d_cols.index(c) for c in cols]
    s_norm = sorted(tuple(_norm(r[i]) for i in si) for r in s_rows)
    d_norm = sorted(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if s_norm != d_norm:
        s_set, d_set = set(s_norm), set(d_norm)
        only_s = [r for r in s_norm if r not in d_set][:3]
        only_d = [r for r in d_norm if r not in s_set][:3]
        out["error"] = f"values differ; columns {cols}; spark-only {only_s}; oracle-only {only_d}"
    out["ok"] = "error" not in out and not type_diff
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tillwise.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = good = unchecked = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            res = compare(qs[name](spark, sf_dir), con, sqls[name]) if name in sqls else {
                "ok": None, "spark_rows": qs[name](spark, sf_dir).count()}
        except Exception as exc:  # report and continue with the next question
            res = {"ok": False, "error": f"{type(exc).__name__}: {str(exc)[:600]}"}
        bad += res.get("ok") is False
        good += res.get("ok") is True
        unchecked += res.get("ok") is None
        print(f"{name:28s} {time.time() - t0:6.2f}s {res}", flush=True)
    print(f"summary: {good} ok, {bad} failed, {unchecked} without oracle ({sf_dir})", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
