"""Compare a registered query with its SQL twin on the same tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or v is pd.NaT:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


_KINDS = {
    "bigint": "int64", "int": "int32", "double": "double", "string": "string", "boolean": "bool",
    "timestamp_ntz": "timestamp[us]", "timestamp": "timestamp[us]", "date": "date32[day]", "float": "float",
}


def rows_of(table) -> list[tuple]:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    out = [tuple(_plain(v) for v in r) for r in zip(*data, strict=True)] if data else []
    return sorted(out, key=repr)


def difference(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when names, types, and all rows agree; else what differs first."""
    got = fn(spark, sf_dir).toArrow()
    want = con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} against {sorted(want.column_names)}"
    types = {c: (str(got.schema.field(c).type), str(want.schema.field(c).type)) for c in got.column_names}
    odd = {c: t for c, t in types.items() if t[0].replace("large_", "") != t[1].replace("large_", "")}
    if odd:
        return f"types {odd}"
    if got.num_rows != want.num_rows:
        return f"{got.num_rows} rows against {want.num_rows}"
    for a, b in zip(rows_of(got), rows_of(want), strict=True):
        if a != b:
            return f"row {a} against {b}"
    return None
