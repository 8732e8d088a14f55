"""Spark result vs. DuckDB SQL result: row count, column names and an
order-insensitive multiset of rows (doubles rounded).  Used by the tests."""

from __future__ import annotations

import math
from collections import Counter

from ..sources.tables import TABLES


def _norm(v, digits: int):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True), digits)
    return v


def duckdb_result(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    rows = rel.fetchall()
    con.close()
    return cols, rows, types


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "tinyint": "TINYINT", "smallint": "SMALLINT",
                 "binary": "BLOB"}


def compare(spark_df, sql: str, sf_dir: str, digits: int = 6) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows, d_types = duckdb_result(sql, sf_dir)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    st = dict(spark_df.dtypes)
    dt = dict(zip(d_cols, d_types))
    mism = {c: (st[c], dt[c]) for c in s_cols if SPARK_TO_DUCK.get(st[c], st[c].upper()) != dt[c]}
    if mism:
        out["type_mismatch"] = mism
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i], digits) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i], digits) for i in di) for r in d_rows)
    out["match"] = sc == dc
    if not out["match"]:
        out["only_spark"] = list((sc - dc).elements())[:3]
        out["only_oracle"] = list((dc - sc).elements())[:3]
    return out
