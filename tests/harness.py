"""Spark-vs-DuckDB comparison, as the correctness gate does it (row count, columns, values)."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = True  # exact float equality, as a value hash would see it


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if STRICT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 and getattr(v, "hour", 0) == 0 else v.isoformat()
    return v


_SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
    "smallint": "SMALLINT",
}


def type_mismatches(spark_df, con, sql: str) -> list:
    """Columns whose Spark type and DuckDB type differ."""
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for c, t in spark_df.dtypes:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        if duck_types.get(c) != want:
            out.append((c, t, duck_types.get(c)))
    return out


def compare(spark_df, con, sql: str) -> dict:
    """{'rows': (n_spark, n_duck), 'columns_ok': bool, 'values_ok': bool, 'diff': sample}."""
    s_cols = sorted(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_data = res.fetchall()
    d_cols = sorted(d_cols_raw)
    idx = [d_cols_raw.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_data]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    s_sorted, d_sorted = sorted(s_rows, key=key), sorted(d_rows, key=key)
    out = {
        "rows": (len(s_rows), len(d_rows)),
        "columns_ok": s_cols == d_cols,
        "values_ok": s_sorted == d_sorted,
    }
    out["types_ok"] = not type_mismatches(spark_df, con, sql)
    if not out["types_ok"]:
        out["type_diff"] = type_mismatches(spark_df, con, sql)
    if not out["columns_ok"]:
        out["diff"] = (s_cols, d_cols)
    elif not out["values_ok"]:
        ds = set(d_sorted)
        ss = set(s_sorted)
        out["diff"] = ([r for r in s_sorted if r not in ds][:3], [r for r in d_sorted if r not in ss][:3], s_cols)
    return out
