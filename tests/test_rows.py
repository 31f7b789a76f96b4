from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tabloom as t
from tabloom.operators import rows


def test_filter(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "i int, s string")
    assert t.filter_rows(df).count() == 0
    assert [r.i for r in t.filter_rows(df, "i > 0 AND s LIKE 'a%'").collect()] == [1]
    assert t.filter_rows(df, "NOT i = 1").count() == 1
    name = t.publish_view(df, "acme", "other")
    assert [r.i for r in t.filter_rows(df, f"i = (SELECT max(i) FROM {name})").collect()] == [2]
    t.drop_view(spark, "acme", "other")


def test_order(spark):
    df = spark.createDataFrame([(2, "b"), (None, "a"), (1, "c"), (2, "a")], "i int, s string")
    assert [r.i for r in t.order_rows(df, "i").collect()] == [None, 1, 2, 2]
    assert [tuple(r) for r in t.order_rows(df, "i, s", "desc").collect()] == \
        [(2, "b"), (2, "a"), (1, "c"), (None, "a")]
    assert [r.i for r in t.order_rows(df, "-i", "ASC").collect()] == [None, 2, 2, 1]
    assert [r.i for r in t.order_rows(df, "i", "ASC  nulls last").collect()][-1] is None
    assert t.order_rows(df, "i").columns == ["i", "s"]
    with pytest.raises(ValueError):
        t.order_rows(df, "i", "upwards")


def test_order_spreads_one_frequent_key(spark):
    """Full copies of one row, a third of the table, end in several sorted ranges."""
    df = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = t.order_rows(df, "k").withColumn("p", F.spark_partition_id())
        where = placed.where("k = 500").groupBy("p").count().collect()
        assert len(where) >= 2
        ranges = placed.groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi")
                                         ).orderBy("p").collect()
        assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:], strict=False))
        assert placed.count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_limit_and_preview(spark):
    df = spark.range(100)
    assert t.limit_rows(df, "7").count() == 7
    assert t.preview(df).count() == 20
    assert [r.id for r in t.top_rows(df, "id", 3, "DESC").collect()] == [99, 98, 97]


def test_large_limits_are_spread(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("v", (F.col("id") * 37) % 1000)
    for n in (11, 142, 143, 500, 999, 1000, 5000):
        out = t.limit_rows(df, n, spread=True)
        assert out.count() == min(n, 1000) and out.columns == ["id", "v"]
    first = t.limit_rows(t.order_rows(df, "v"), 300, True)
    assert sorted(r.v for r in first.collect()) == list(range(300))
    assert "SinglePartition" not in first._jdf.queryExecution().executedPlan().toString()
    assert t.limit_rows(df.where("id < 0"), 50, True).count() == 0
    best = t.top_rows(df, "v", 300, "DESC", spread=True)
    assert [r.v for r in best.collect()] == list(range(999, 699, -1))
    assert "TakeOrdered" not in best._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order", ["ASC", "DESC", "ASC NULLS LAST", "DESC NULLS FIRST"])
def test_large_top_rows_move_few_rows(spark, monkeypatch, order):
    """The same rows as a full sort gives, out of about as many as are kept."""
    i = F.col("id")
    df = spark.range(0, 60_000, numPartitions=6).select(
        "id", F.when(i % 97 == 0, None).otherwise((i * 7919) % 50_021).alias("v"),
        F.when(i % 3 == 0, F.lit("same")).otherwise(F.md5(i.cast("string"))).alias("s"))
    monkeypatch.setattr(rows, "SAMPLED_KEYS", 200)
    written, write = [], rows.stage
    monkeypatch.setattr(rows, "stage", lambda d, name: written.append(d) or write(d, name))
    for columns, limit in (("v, id", 5_000), ("s, v, id", 700), ("v, id", 59_999), ("v, id", 60_001),
                           ("id % 7, s, id", 30_000)):
        written.clear()
        found = t.top_rows(df, columns, limit, order, spread=True)
        want = t.order_rows(df, columns, order).limit(limit)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.collect()]
        most = [d.count() for d in written if "id" in d.columns]
        assert sum(most) <= 2 * limit


def test_large_top_rows_of_one_key(spark, monkeypatch):
    """A key with more rows than there is room for gives any of them."""
    df = spark.range(0, 30_000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 11).alias("v"))
    for limit in (100, 9_000, 16_000, 25_000):
        found = t.top_rows(df, "v", limit, spread=True).collect()
        assert [r.v for r in found] == [r.v for r in df.orderBy("v").limit(limit).collect()]
        assert len({r.id for r in found}) == limit
    assert t.top_rows(df, "v", 0, spread=True).count() == 0
    assert t.top_rows(df.where("id < 0"), "v", 5, spread=True).count() == 0
    nans = spark.createDataFrame([(float("nan"),), (1.0,), (None,), (2.0,)], "v double")
    assert [str(r.v) for r in t.top_rows(nans, "v", 3, "DESC", spread=True).collect()] == [
        "nan", "2.0", "1.0"]


def test_order_spreads_a_key_that_was_brought_together(spark):
    """Different rows of one key, all in one partition after a shuffle on it."""
    df = spark.range(0, 40_000).select(
        "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k")).repartition(8, "k")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = t.order_rows(df, "k").withColumn("p", F.spark_partition_id())
        assert placed.where("k = 7").select("p").distinct().count() >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_order_by_partition_reads_few_columns(spark, table):
    """Ties are spread by where rows come from, and columns nobody asks for stay unread."""
    def read(**how) -> str:
        plan = t.order_rows(table("orders"), "o_orderdate", **how).select("o_orderdate")
        text = plan._jdf.queryExecution().executedPlan().toString()
        return text[text.index("ReadSchema"):].split("\n")[0]
    assert read(spread_ties="partition").count(":") == 2
    assert read().count(":") > 2
    df = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ordered = t.order_rows(df, "k", spread_ties="partition")
        placed = ordered.withColumn("p", F.spark_partition_id())
        assert placed.where("k = 500").select("p").distinct().count() >= 2
        keys = [r.k for r in ordered.collect()]
        assert len(keys) == 60_000 and keys == sorted(keys)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    with pytest.raises(ValueError):
        t.order_rows(df, "k", spread_ties="rows")


def test_append_widens(spark, ansi):
    one = spark.sql("SELECT 1 a, 'x' b, 2 c, CAST(1.5 AS DECIMAL(4,1)) d, 1 e")
    two = spark.sql("SELECT 'y' p, 2 q, 2.5D r, CAST(2.25 AS DECIMAL(4,2)) s, 3000000000 f")
    out = t.append_rows(one, two)
    assert out.dtypes == [("a", "string"), ("b", "string"), ("c", "double"), ("d", "decimal(5,2)"),
                          ("e", "bigint")]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1", "x", 2.0, Decimal("1.50"), 1), ("y", "2", 2.5, Decimal("2.25"), 3000000000)]
    with pytest.raises(ValueError):
        t.append_rows(one, two.drop("p"))


def test_append_keeps_copies_and_order_of_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], ["a", "b"])
    assert t.append_rows(df, df.select("b", "a")).count() == 4
    dates = spark.sql("SELECT DATE'2024-01-01' d")
    assert t.append_rows(dates, spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' x")).dtypes == \
        [("d", "timestamp")]
