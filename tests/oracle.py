"""Compare a Spark result with the rows of a SQL statement run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "0" if number == 0 else f"{number:.10g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in place], sorted(tuple(plain(r[i]) for i in place) for r in rows)


KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def type_differences(df, con, sql) -> str:
    """Columns whose types do not correspond."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    got = {c: KINDS.get(t, t) for c, t in df.dtypes}
    return ", ".join(f"{c}: {got[c]} vs {want.get(c)}" for c in got if got[c] != want.get(c))


def differences(df, con, sql) -> str:
    """Empty when both give the same columns and the same bag of rows."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}; spark {got[:2]} sql {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else ""
