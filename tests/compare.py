"""Run a query and its SQL over the same tables and compare all rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def difference(df, con, sql: str) -> str | None:
    """None when columns, row count and rows agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    names = sorted(columns)
    kinds = dict(df.dtypes)
    ours = sorted(tuple(plain(row[n]) for n in names) for row in df.collect())
    index = [columns.index(n) for n in names]
    expected = sorted(tuple(plain(row[i]) for i in index) for row in theirs)
    if len(ours) != len(expected):
        return f"{len(ours)} rows vs {len(expected)}"
    sql_kinds = {d[0]: str(d[1]) for d in result.description} if result.description else {}
    for name in names:
        if kinds[name] == "bigint" and sql_kinds.get(name) not in ("BIGINT", "NUMBER"):
            return f"{name}: bigint vs {sql_kinds.get(name)}"
        if kinds[name] == "int":
            return f"{name}: int, cast it"
    wrong = [(a, b) for a, b in zip(ours, expected) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {names}: {wrong[0][0]} vs {wrong[0][1]}" if wrong else None
