"""Compare a Spark query with its SQL oracle (DuckDB), order-insensitively.

Used by the tests and by ``python -m streamtab.plans.verify``.  Values are
normalised (timestamps as ISO text, floats to 9 significant digits) and rows
compared as sorted multisets.
"""

from __future__ import annotations

import datetime as _dt
import math
import sys

from ..sources.tables import TABLES


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, con=None, queries=None, sql=None) -> dict:
    from .registry import ORACLE_SQL, QUERIES, STREAM_ORACLE_SQL, STREAM_QUERIES
    queries = queries or {**QUERIES, **STREAM_QUERIES}
    sql = sql or {**ORACLE_SQL, **STREAM_ORACLE_SQL}
    con = con or duckdb_conn(sf_dir)
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols)}
    out["values_match"] = out["cols_match"] and _rows(s_cols, s_rows) == _rows(o_cols, o_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(o_cols)
    elif not out["values_match"]:
        a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_oracle"] = [x for x in b if x not in sa][:3]
    return out


def main(argv=None) -> int:
    import json
    from ..session import get_session
    from .oracle import ORACLE_SQL
    from .streams import STREAM_ORACLE_SQL
    argv = argv if argv is not None else sys.argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(ORACLE_SQL) + list(STREAM_ORACLE_SQL)
    spark = get_session("local[8]", partitions=8)
    con = duckdb_conn(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("values_match", False)
        bad += not ok
        print(json.dumps(r, default=str), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
