"""Compare a Spark result with DuckDB running the oracle SQL on the same parquet.

Values are compared after normalising types (decimals, dates, timestamps as
text; floats rounded) and sorting rows - order-insensitive, like the driver.
"""

from __future__ import annotations

import datetime as _dt
import decimal

from lakeshift.queries.fixtures import Tables

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf_dir}/{n}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def normalised(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows = duckdb_rows(sql, sf_dir)
    sc, sr = normalised(s_cols, s_rows)
    dc, dr = normalised(d_cols, d_rows)
    res = {"name": name, "spark_rows": len(sr), "oracle_rows": len(dr), "cols_equal": sc == dc, "values_equal": sr == dr}
    if not res["cols_equal"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
    elif not res["values_equal"]:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    res["ok"] = res["cols_equal"] and res["values_equal"] and len(sr) == len(dr)
    return res


__all__ = ["compare", "duckdb_rows", "normalised", "Tables"]
