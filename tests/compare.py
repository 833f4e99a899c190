"""Run registered queries and their checking SQL side by side."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def type_difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    """Columns whose types differ, as ``{name: (spark, duckdb)}``."""
    here = {name: _TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    there = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {name: (kind, there.get(name)) for name, kind in here.items() if kind != there.get(name)}


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    columns, rows = expected(con, sql)
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(columns)}"
    got = bag(spark_df.columns, spark_df.collect())
    want = bag(columns, rows)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(want.values())};"
        f" extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )
