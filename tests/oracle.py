"""Run a registered query and its SQL counterpart over the same tables and compare the rows."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, entry, tables) -> str | None:
    """None when both sides agree, else a short account of the first difference."""
    frame = entry.run(tables)
    ours = sorted_rows(frame.columns, frame.collect())
    answer = connection.execute(entry.sql)
    theirs = sorted_rows([item[0] for item in answer.description], answer.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    only_ours, only_theirs = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    return (
        f"{len(ours[1])} rows against {len(theirs[1])}; {len(only_ours)} only ours, {len(only_theirs)} only theirs; "
        f"{sorted(only_ours)[:2]} / {sorted(only_theirs)[:2]}"
    )
