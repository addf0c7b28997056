"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

The gate: row count, column names, order-insensitive
values (columns sorted by name, rows sorted, doubles compared at 1e-6).
"""

from __future__ import annotations

import datetime as dt
import math

from airshed.plans.catalog import TABLES


def duckdb_run(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


SPARK_TO_DUCKDB = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duckdb_types(sf_dir: str, sql: str) -> dict[str, str]:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (3, f"{round(v, 6):.6f}")
    if isinstance(v, int):
        return (3, f"{float(v):.6f}")
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    if hasattr(v, "as_tuple"):  # Decimal
        return (3, f"{float(v):.6f}")
    if isinstance(v, (list, tuple)):
        return (5, repr([_norm(x) for x in v]))
    return (6, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, query, sql: str) -> dict:
    df = query(spark, sf_dir)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    o_cols, o_rows = canon(*duckdb_run(sf_dir, sql))
    res = {
        "query": name,
        "rows_spark": len(s_rows),
        "rows_oracle": len(o_rows),
        "columns_match": s_cols == o_cols,
        "values_match": s_rows == o_rows,
    }
    if s_cols != o_cols:
        res["columns"] = (s_cols, o_cols)
    elif s_rows != o_rows:
        diff = [(a, b) for a, b in zip(s_rows, o_rows) if a != b][:3]
        res["first_diffs"] = diff
    want = duckdb_types(sf_dir, sql)
    type_diff = {
        c: (t, want.get(c)) for c, t in df.dtypes if SPARK_TO_DUCKDB.get(t, t.upper()) != want.get(c)
    }
    res["types_match"] = not type_diff
    if type_diff:
        res["type_diff"] = type_diff
    res["ok"] = res["columns_match"] and res["values_match"] and res["types_match"]
    return res
