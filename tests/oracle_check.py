"""Run registered queries on Spark and their SQL on DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def _bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty when both agree, else what differs."""
    start = time.time()
    df = query(spark, sf_dir)
    got_columns, got = _bag(df.columns, df.collect())
    seconds = time.time() - start
    cursor = con.execute(sql)
    want_columns, want = _bag([d[0] for d in cursor.description], cursor.fetchall())
    print(f"{name}: {seconds:.1f}s {sum(got.values())} rows")
    if got_columns != want_columns:
        return f"{name}: columns {got_columns} != {want_columns}"
    if not got:
        return f"{name}: no rows"
    if got != want:
        only_got, only_want = got - want, want - got
        return (
            f"{name}: spark {sum(got.values())} sql {sum(want.values())}; only spark {sum(only_got.values())} "
            f"{list(only_got)[:2]}; only sql {sum(only_want.values())} {list(only_want)[:2]}"
        )
    return ""
