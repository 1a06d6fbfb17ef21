"""Runs a query in Spark and its SQL in DuckDB and compares the two results."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def normal(v):
    if isinstance(v, Decimal):
        return ("dec", str(v))
    return v


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def differences(df, con, sql) -> list[str]:
    """What differs: column names, types, row counts, values. Empty when all is equal."""
    got_rows = df.collect()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want_rows = res.fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for name, t in df.dtypes:
        want = TYPES.get(t, t.upper().replace("DECIMAL", "DECIMAL"))
        if want.replace(" ", "") != types[name].replace(" ", ""):
            out.append(f"type of {name}: {t} vs {types[name]}")
    if len(got_rows) != len(want_rows):
        out.append(f"rows {len(got_rows)} vs {len(want_rows)}")
    got, want = multiset(df.columns, got_rows), multiset(names, want_rows)
    if got != want:
        out.append(f"only in spark {list((got - want).items())[:3]}; only in sql {list((want - got).items())[:3]}")
    return out
