"""CSV tables with a schema given by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabloom.operators.rows import limit_rows


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType,
    separator: str = ",", row_limit: int | None = None, cache: bool = False,
) -> DataFrame:
    """Rows of CSV files with a header line, at any path Spark can reach.

    The schema (a DDL string or ``StructType``) is applied by position and never
    guessed; a field that does not fit its type is NULL. ``row_limit`` keeps that
    many rows, without saying which.
    """
    df = spark.read.csv(path, schema=schema, header=True, sep=separator, mode="PERMISSIVE")
    if row_limit is not None:
        df = limit_rows(df, row_limit)
    return df.cache() if cache else df


def read_tenant_csv(
    spark: SparkSession, client_name: str, filename: str, schema: str | T.StructType,
    delimiter: str = ",", row_limit: int | None = None, base: str = "s3a:/",
    cache: bool = False,
) -> DataFrame:
    """A tenant's file in an object store: ``{base}/{client}/files/{filename}``."""
    uri = f"{base}/{client_name}/files/{filename}"
    return read_csv(spark, uri, schema, delimiter, row_limit, cache)


def write_csv(df: DataFrame, path: str, separator: str = ",", mode: str = "error") -> None:
    """The form ``read_csv`` reads back: header line, ISO dates and times."""
    df.write.csv(path, header=True, sep=separator, mode=mode)
