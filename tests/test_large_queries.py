"""Queries that rest on sketches, on more values than a sketch keeps, against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import difference

NAMES = ["group_frequent_merge", "group_kll_exact", "group_theta_common", "group_theta_union"]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events"))
    i = F.col("id")
    spark.range(0, 300_000, numPartitions=8).select(
        i.alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + i % 5 * 86_400).alias("ts"),
        F.pmod(F.xxhash64(i % 100_000), F.lit(10**12)).alias("user_id"),
        F.when(i % 3 == 0, "view").otherwise("click").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit("").alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_more_values_than_a_sketch_keeps(spark, events, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{events}/events.parquet/*.parquet'")
    assert difference(entry.queries()[name](spark, events), con, entry.oracle_sql()[name]) is None
