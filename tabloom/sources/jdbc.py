"""JDBC tables."""

from __future__ import annotations

import contextlib
import io
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabloom.functions.checkpoints import stage as written
from tabloom.functions.params import choose

POSTGRES_DRIVER = "org.postgresql.Driver"
SAVE_MODES = {m: m for m in ("overwrite", "append", "ignore", "error", "errorifexists")}


def connection_options(
    host: str = "", port: str | int = "", db: str = "", user: str | None = None,
    password: str | None = None, url: str | None = None, driver: str | None = None,
) -> dict[str, str]:
    """Connection options from host, port and database (PostgreSQL), or from a URL."""
    if url is None:
        url = f"jdbc:postgresql://{host}:{port}/{db}"
        driver = driver or POSTGRES_DRIVER
    options = {"url": url, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in options.items() if v is not None}


def read_jdbc(
    spark: SparkSession, table: str, connection: dict[str, str],
    partition_column: str | None = None, lower_bound: Any = None, upper_bound: Any = None,
    num_partitions: int | None = None, fetch_size: int = 10_000,
) -> DataFrame:
    """A table, or a subquery ``(select ..) t``, with the schema the database reports.

    With ``partition_column`` and ``num_partitions`` the table is read over that many
    connections; bounds left out are asked from the database in one small query.
    The bounds only place the cuts: rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(**connection, fetchsize=str(fetch_size))
    if partition_column is None:
        return reader.option("dbtable", table).load()
    if not num_partitions:
        raise ValueError("partition_column needs num_partitions")
    if lower_bound is None or upper_bound is None:
        source = table if table.lstrip().startswith("(") else f"{table} t"
        probe = f"(select min({partition_column}) lo, max({partition_column}) hi from {source}) b"
        low, high = reader.option("dbtable", probe).load().first()
        lower_bound = low if lower_bound is None else lower_bound
        upper_bound = high if upper_bound is None else upper_bound
        if lower_bound is None or upper_bound is None:
            return reader.option("dbtable", table).load()
    return reader.options(
        dbtable=table, partitionColumn=partition_column, lowerBound=str(lower_bound),
        upperBound=str(upper_bound), numPartitions=str(num_partitions),
    ).load()


def source_tables(df: DataFrame) -> list[str]:
    """The JDBC tables and subqueries that ``df`` reads, as its plan names them."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("extended")
    return re.findall(r"JDBCRelation\((.*?)\) \[numPartitions", shown.getvalue(), re.DOTALL)


def reads_table(sources: list[str], table: str) -> bool:
    """Whether a source names the table. Names with the same last part count as the same
    table where one has a schema and the other none, as the default schema is not known."""
    def plain(text: str) -> str:
        return re.sub(r'["`\[\]]', "", text).lower()

    target = plain(table).split(".")
    found = re.findall(r"[\w$]+(?:\s*\.\s*[\w$]+)*", " ".join(map(plain, sources)))
    for name in found:
        parts = re.split(r"\s*\.\s*", name)
        shared = min(len(parts), len(target))
        if parts[-shared:] == target[-shared:]:
            return True
    return False


def write_jdbc(
    df: DataFrame, table: str, connection: dict[str, str], mode: str = "overwrite",
    num_partitions: int | None = None, batch_size: int = 10_000, stage: bool = False,
) -> None:
    """Write a table in one of the save modes; nothing is printed or read back.

    Overwriting drops the table before the rows are computed, so a ``df`` that reads
    the target is refused, unless ``stage`` writes the rows to the shared folder
    first. Equal column names are refused before anything is touched.
    ``num_partitions`` bounds the number of connections.
    """
    choose(SAVE_MODES, mode, "save mode")
    names = [c.lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns occur more than once: {twice}")
    if mode == "overwrite":
        if stage:
            df = written(df, "overwrite")
        elif reads_table(source_tables(df), table):
            raise ValueError(f"{table} is read by the rows that would overwrite it; use stage=True")
    options = {**connection, "dbtable": table, "batchsize": str(batch_size)}
    if num_partitions:
        options["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**options).mode(mode).save()
