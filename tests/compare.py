"""Spark result against the DuckDB result of the same named query."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def kind(dtype: str) -> str:
    """One name per type for both engines."""
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "DATE": "date",
    }
    return names.get(dtype, dtype.lower())


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v)[:10] if hasattr(v, "isoformat") else v)
        elif str(frame[c].dtype).startswith("datetime"):
            frame[c] = frame[c].dt.strftime("%Y-%m-%d")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if column names, types, row count and every value agree exactly."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, (kind(str(t)) for t in relation.types)))
    actual_types = dict(spark_df.dtypes)
    if expected_types != actual_types:
        return [f"{c}: {actual_types.get(c)} against {expected_types.get(c)}"
                for c in sorted(expected_types.keys() | actual_types.keys())
                if actual_types.get(c) != expected_types.get(c)]
    actual, expected = ordered(spark_df.toPandas()), ordered(relation.df())
    if len(actual) != len(expected):
        return [f"{len(actual)} rows against {len(expected)}"]
    found = []
    for c in actual.columns:
        a, e = actual[c], expected[c]
        same = (a == e) | (a.isna() & e.isna())
        if not same.all():
            i = (~same).idxmax()
            found.append(f"{c}: {int((~same).sum())} values differ, first {a[i]!r} against {e[i]!r}")
    return found
