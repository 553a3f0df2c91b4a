"""Run a registered query and its SQL side by side and compare the rows as multisets."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels".split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(directory, table)}.parquet'")
    return connection


def as_multiset(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, connection, text: str) -> str | None:
    """None if both sides hold the same columns and rows, else a short report."""
    names, ours = as_multiset(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(text)
    other_names, theirs = as_multiset([c[0] for c in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if ours != theirs:
        here, there = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{sum(ours.values())} / {sum(theirs.values())} rows, only here {here}, only there {there}"
    return None
