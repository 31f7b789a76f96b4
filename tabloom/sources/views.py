"""Named views, one namespace per tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def view_name(client: str, step_id: str) -> str:
    """Jobs of several tenants can share a session without clashing."""
    return f"{client}_tbl_{step_id}"


def publish_view(df: DataFrame, client: str, step_id: str) -> str:
    """Register (or replace) a view and return its name; no rows are moved."""
    name = view_name(client, step_id)
    df.createOrReplaceTempView(f"`{name}`")
    return name


def scan_view(spark: SparkSession, client: str, step_id: str) -> DataFrame:
    return spark.table(f"`{view_name(client, step_id)}`")


def drop_view(spark: SparkSession, client: str, step_id: str) -> bool:
    """Drop a consumed view; true if it was there."""
    return spark.catalog.dropTempView(view_name(client, step_id))
