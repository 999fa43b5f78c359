"""Run a registered query and its SQL and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """One spelling per value, types kept apart."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, float):
        return f"d:{value!r}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, decimal.Decimal):
        return f"n:{value}"
    if isinstance(value, datetime.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return f"s:{value}"


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    return [columns[i] for i in order], rows


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account."""
    names, ours = spark_rows(df)
    their_names, theirs = sql_rows(con, sql)
    if names != their_names:
        return f"columns {names} != {their_names}"
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(ours)][:2]
    cut = lambda rows: [[c[:90] for c in r] for r in rows]
    return f"{len(ours)} vs {len(theirs)} rows; {names}\n  spark {cut(only_ours)}\n  sql   {cut(only_theirs)}"
