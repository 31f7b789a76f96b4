"""Every operator as a query on the generated tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add(name: str, query: Query, sql: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is there already")
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def on(name: str, table: str, columns: str, apply: Callable[[DataFrame], DataFrame],
       sql: str) -> None:
    """A query on one table: the named columns, then the operator."""
    add(
        name,
        lambda spark, sf: apply(load(spark, sf, table).select(*columns.split())),
        f"SELECT {', '.join(columns.split())}, {sql} FROM {table}",
    )


def load_all() -> None:
    from catalogue import columns, dates, joins, numbers, sketches, sources, texts, windows  # noqa: F401, E501
