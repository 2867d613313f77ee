"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare
row count, column names and (order-insensitive) rounded values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from stayframe.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~",)
        if v == int(v) and abs(v) < 2**53:
            return ("n", int(v))
        return ("f", round(v, 5))
    if isinstance(v, (pd.Timestamp,)):
        return ("t", str(v.tz_localize(None) if v.tzinfo else v))
    if hasattr(v, "isoformat"):
        return ("t", str(pd.Timestamp(v)))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_cell(x) for x in v))
    if hasattr(v, "tolist"):
        return ("l", tuple(_cell(x) for x in v.tolist()))
    if isinstance(v, bool):
        return ("n", int(v))
    if isinstance(v, int):
        return ("n", v)
    try:
        import numpy as np
        if isinstance(v, np.integer):
            return ("n", int(v))
        if isinstance(v, np.floating):
            return _cell(float(v))
    except ImportError:
        pass
    return ("s", str(v))


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return cols, sorted(tuple(_cell(v) for v in r) for r in pdf.itertuples(index=False, name=None))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE"}


def type_diffs(spark_df, con, sql: str):
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in spark_df.schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return [(c, st[c], dt.get(c)) for c in st if st[c] != dt.get(c)]


def compare(spark_df, con, sql: str):
    diffs = type_diffs(spark_df, con, sql)
    if diffs:
        return False, f"column types differ (name, spark, duck): {diffs}"
    s_cols, s_rows = rows_of(spark_df.toPandas())
    d_cols, d_rows = rows_of(con.execute(sql).df())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(s_rows)} rows"
