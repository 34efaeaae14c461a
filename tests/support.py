"""Comparing a Spark result with DuckDB."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (date, Decimal)):
        return str(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def difference(df, con, sql: str) -> str | None:
    """None if the frame and the SQL agree on columns, types and rows, else what differs."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    kinds = {d[0]: str(d[1]) for d in want.description}
    rows = want.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind.upper()) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    got = rows_of(df.columns, df.collect())
    expected = rows_of(names, rows)
    if got == expected:
        return None
    only_got = [r for r in got if r not in set(expected)][:3]
    only_want = [r for r in expected if r not in set(got)][:3]
    return f"{len(got)} rows vs {len(expected)}; only spark {only_got}; only sql {only_want}"
