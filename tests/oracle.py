"""Comparing a query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """A comparable form that keeps types apart only where values differ."""
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return ("d", value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


FAMILY = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def difference(df, con, sql: str) -> str | None:
    """None where both agree, else what differs."""
    relation = con.sql(sql)
    left = dict(zip(df.columns, (f.dataType.simpleString() for f in df.schema), strict=True))
    right = dict(zip(relation.columns, (str(t) for t in relation.types), strict=True))
    if sorted(left) != sorted(right):
        return f"columns {sorted(left)} and {sorted(right)}"
    for name, kind in left.items():
        want = FAMILY.get(kind, kind.upper())
        if want.replace(" ", "") != right[name].replace(" ", ""):
            return f"type of {name}: {kind} and {right[name]}"
    order = sorted(left)
    spark_rows = Counter(
        tuple(plain(r[c]) for c in order) for r in df.select(*[f"`{c}`" for c in order]).collect()
    )
    positions = [relation.columns.index(c) for c in order]
    sql_rows = Counter(tuple(plain(r[i]) for i in positions) for r in relation.fetchall())
    if spark_rows != sql_rows:
        extra, missing = spark_rows - sql_rows, sql_rows - spark_rows
        return (f"rows {sum(spark_rows.values())} and {sum(sql_rows.values())}; "
                f"only in Spark {list(extra)[:2]}; only in SQL {list(missing)[:2]}")
    return None
